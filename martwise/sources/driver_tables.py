"""Raw-shaped inputs derived from the TPC-H-like driver tables.

The builders take raw records (text fields, nested structs, arrays), the
shape the JSON exports have.  These adapters derive such records from the
Parquet driver tables with plain projections, so every builder runs its
full parse / coerce / key path on data whose size grows with the tables.
Text is produced in the forms the exports use: ISO timestamps with 'Z',
with '+07:00', and date-only; amounts and ids as text.

Mapping (the oracle SQL repeats it as flat SQL):

* orders: ``k = o_orderkey``; ``k % 3`` picks Shopify / Sapo POS / online;
  status F completed, O pending, P cancelled (refunded when ``k % 7 = 0``),
  none when ``k % 10 = 0``; transaction id is the text of ``k``, blank
  when ``k % 97 = 5``; VND = trunc(price * 25000).
* line items: every lineitem row is one single-item order fragment
  (header from its order); the line number is the item position.
* payments: one per order; PayPal / MoMo / ZaloPay by ``k % 3``; paid ``k % 72``
  hours after the order; where ``k % 4 = 0`` under an id that no order has.
* cart events: events; customer id missing when ``event_id % 50 = 0``.
* bank transactions: one per customer, dated 1994-12-01 + custkey days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwise import schemas
from martwise.functions.columns import USD_TO_VND_RATE
from martwise.sources.json_sources import SEQ, TAG, conform_raw, struct_of

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Declared schemas of the driver tables: reading with them skips the
# schema-inference pass over the Parquet footers.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(DRIVER_SCHEMAS[name]) if name in DRIVER_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _txt(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _iso_z(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _iso_plus7(ts: Column) -> Column:
    return F.concat(F.date_format(ts + F.expr("INTERVAL 7 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"),
                    F.lit("+07:00"))


def _vnd(usd: Column) -> Column:
    """trunc(usd * rate): the cast truncates toward zero; an amount beyond
    the bigint range gives null instead of failing the job (ANSI)."""
    return (usd * F.lit(USD_TO_VND_RATE)).try_cast("bigint")


def _seq(table: str, pos: Column) -> Column:
    return F.struct(F.lit(table).alias("file"), pos.cast("bigint").alias("pos"))


def _order_header(k: Column) -> dict[str, Column]:
    """Fields every order source shares (as text)."""
    st = F.col("o_orderstatus")
    status = (F.when(k % 10 == 0, F.lit(None).cast("string"))
               .when(st == "F", "completed").when(st == "O", "pending")
               .when((st == "P") & (k % 7 == 0), "refunded").when(st == "P", "cancelled"))
    return {
        "transaction_id": F.when(k % 97 == 5, F.lit("")).otherwise(_txt(k)),
        "status": status,
        "total_vnd_text": _txt(_vnd(F.col("o_totalprice"))),
    }


def _shopify(k: Column, h: dict[str, Column]) -> dict[str, Column]:
    st = F.col("o_orderstatus")
    return {
        "id": _txt(k), "order_number": F.concat(F.lit("SH-"), _txt(k)),
        "transaction_id": h["transaction_id"], "customer_id": _txt("o_custkey"),
        "order_date": _iso_z(F.col("o_orderdate")), "payment_gateway": F.lit("shopify_payments"),
        "payment_status": F.when(st == "F", "paid").when(st == "O", "pending").otherwise("voided"),
        "status": h["status"], "total_vnd": h["total_vnd_text"],
        "total_usd": _txt("o_totalprice"), "source": F.lit("shopify"),
    }


def _sapo(k: Column, h: dict[str, Column]) -> dict[str, Column]:
    return {
        "id": _txt(k), "code": F.concat(F.lit("SP-"), _txt(k)),
        "transaction_id": h["transaction_id"],
        "customer": F.struct(_txt("o_custkey").alias("id")),
        "location_id": _txt(k % 25), "created_at": _iso_plus7(F.col("o_orderdate")),
        "status": h["status"], "payment_method": F.when(k % 2 == 0, "cash").otherwise("card"),
        "total_vnd": h["total_vnd_text"], "total_usd": _txt("o_totalprice"),
    }


def _online(k: Column, h: dict[str, Column]) -> dict[str, Column]:
    return {
        "order_id": _txt(k), "transaction_id": h["transaction_id"],
        "customer": F.struct(_txt("o_custkey").alias("id")),
        "created_at": F.date_format(F.col("o_orderdate"), "yyyy-MM-dd"),
        "channel": F.when(k % 6 == 2, "lazada").otherwise("tiki"),
        "status": h["status"], "payment_method": F.lit("cod"), "total": h["total_vnd_text"],
    }


def _staff(k: Column) -> dict[str, Column]:
    sid = F.col("o_custkey") % 40
    person = F.struct(_txt(sid).alias("id"), F.concat(F.lit("ST"), _txt(sid)).alias("code"),
                      F.concat(F.lit("Staff "), _txt(sid)).alias("name"),
                      F.when(sid % 3 == 0, F.lit("Cashier")).alias("position"),
                      F.concat(F.lit("staff"), _txt(sid), F.lit("@shop.vn")).alias("email"),
                      F.concat(F.lit("090"), F.lpad(_txt(sid), 7, "0")).alias("phone"))
    use_member = k % 5 == 0
    return {"staff": F.when(~use_member, person), "staff_member": F.when(use_member, person)}


def _by_tag(branches: list[tuple[Column, str, dict[str, Column]]], schema) -> list[Column]:
    """One column per schema field, each a CASE over the branches: a single
    pass over the input emits records of several source shapes.  A field
    that several branches compute the same way is emitted once (under the
    OR of their conditions, or bare when all branches share it), which
    keeps the generated code small."""
    cols = []
    for f in schema.fields:
        groups: dict[str, tuple[Column, Column]] = {}
        for cond, _, fields in branches:
            if f.name in fields:
                k = str(fields[f.name])
                c0, e0 = groups.get(k, (None, fields[f.name]))
                groups[k] = (cond if c0 is None else (c0 | cond), e0)
        if not groups:
            expr = F.lit(None)
        elif len(groups) == 1 and sum(f.name in b[2] for b in branches) == len(branches):
            expr = next(iter(groups.values()))[1]
        else:
            expr = None
            for cond, e in groups.values():
                expr = F.when(cond, e) if expr is None else expr.when(cond, e)
        cols.append(expr.cast(f.dataType).alias(f.name))
    tag = None
    for cond, name, _ in branches:
        tag = F.when(cond, F.lit(name)) if tag is None else tag.when(cond, F.lit(name))
    return cols + [tag.alias(TAG)]


def raw_orders(orders: DataFrame) -> DataFrame:
    """Raw order records of all three sources, one per order, tagged with
    ``_source`` ('shopify', 'sapo_pos', 'online')."""
    k = F.col("o_orderkey")
    h = _order_header(k)
    branches = [(k % 3 == 0, "shopify", _shopify(k, h)),
                (k % 3 == 1, "sapo_pos", {**_sapo(k, h), **_staff(k)}),
                (k % 3 == 2, "online", _online(k, h))]
    return orders.select(*_by_tag(branches, schemas.RAW_ORDER), _seq("orders", k).alias(SEQ))


def raw_order_fragments(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Single-item order fragments of all sources (tagged): each lineitem
    row with its order's header and ``line_items`` = [that item].  Field
    names differ by source, so the builders' fallback chains (P16) all run.
    One join, one pass: the order side is needed only for the header."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    k = F.col("o_orderkey")
    h = _order_header(k)
    ext_vnd = F.col("l_extendedprice") * F.lit(USD_TO_VND_RATE)
    unit = _txt(F.try_divide(ext_vnd, F.col("l_quantity")).try_cast("bigint"))
    total = F.when(F.col("l_linenumber") % 2 == 0, _txt(ext_vnd.try_cast("bigint")))
    qty = _txt("l_quantity")  # "23.0": integer coercion goes through double
    pid = _txt("l_partkey")
    name = F.concat(F.lit("part-"), pid)
    lno = _txt("l_linenumber")
    items = {
        0: {"product_id": pid, "name": name, "quantity": qty, "price_vnd": unit,
            "line_total_vnd": total, "line_number": lno},
        1: {"product_id": pid, "product_name": name, "quantity": qty, "price": unit,
            "total": total, "line_number": lno},
        2: {"id": pid, "name": name, "quantity": qty, "unit_price": unit,
            "line_total": total, "line_number": lno},
    }
    headers = {0: _shopify(k, h), 1: _sapo(k, h), 2: _online(k, h)}
    names = {0: "shopify", 1: "sapo_pos", 2: "online"}
    branches = [(k % 3 == i, names[i],
                 {**headers[i], "line_items": F.array(struct_of(items[i], schemas.LINE_ITEM))})
                for i in (0, 1, 2)]
    return j.select(*_by_tag(branches, schemas.RAW_ORDER), _seq("lineitem", k).alias(SEQ))


def raw_payments(orders: DataFrame) -> DataFrame:
    """Raw gateway records of PayPal, MoMo and ZaloPay in one pass, tagged
    with ``_source`` ('paypal', 'momo', 'zalopay')."""
    k = F.col("o_orderkey")
    tid = (F.when(k % 97 == 5, F.lit("")).when(k % 4 == 0, F.concat(F.lit("X-"), _txt(k))).otherwise(_txt(k)))
    pay_ts = F.col("o_orderdate") + F.make_interval(hours=(k % 72).cast("int"))
    amount = _txt(F.when(k % 5 == 0, (F.col("o_totalprice") * F.lit(USD_TO_VND_RATE // 2)).try_cast("bigint"))
                   .otherwise(_vnd(F.col("o_totalprice"))))
    paypal = {
        "transaction_id": tid, "order_id": _txt(k), "customer_id": _txt("o_custkey"),
        "transaction_amount": F.struct(F.lit("USD").alias("currency_code"),
                                       _txt("o_totalprice").alias("value")),
        "transaction_amount_vnd": amount,
        "transaction_status": F.when(k % 7 == 0, "DENIED").otherwise("COMPLETED"),
        "transaction_initiation_date": _iso_z(pay_ts)}
    momo = {
        "transaction_id": tid, "orderId": _txt(k), "transId": _txt(k), "amount": amount,
        "resultCode": F.when(k % 13 == 0, F.lit(None).cast("string")).when(k % 7 == 0, "1006").otherwise("0"),
        "message": F.lit("ok"), "payType": F.lit("qr"), "responseTimeISO": _iso_plus7(pay_ts)}
    zalopay = {
        "transaction_id": tid, "app_trans_id": _txt(k), "zp_trans_id": _txt(k), "amount": amount,
        "return_code": F.when(k % 7 == 0, "2").otherwise("1"),
        "channel": F.when(k % 2 == 0, "36").otherwise("38"), "bank_code": F.lit("VCB"),
        "server_time_iso": _iso_z(pay_ts)}
    branches = [(k % 3 == 0, "paypal", paypal), (k % 3 == 1, "momo", momo),
                (k % 3 == 2, "zalopay", zalopay)]
    return orders.select(*_by_tag(branches, schemas.RAW_PAYMENT_ANY), _seq("orders", k).alias(SEQ))


def raw_cart_events(events: DataFrame) -> DataFrame:
    """Web-tracking records; event types renamed to the storefront's funnel."""
    e, u, t = F.col("event_id"), F.col("user_id"), F.col("event_type")
    etype = (F.when(t == "signup", "page_view").when(t == "view", "view_item")
              .when(t == "click", "add_to_cart").when(t == "error", "begin_checkout")
              .otherwise(t))
    df = events.select(
        _txt(e).alias("event_id"), etype.alias("event_type"),
        F.concat(F.lit("s"), _txt(u), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        F.when(e % 50 != 0, _txt(u)).alias("customer_id"),
        F.get_json_object("props", "$.k").alias("product_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.when(u % 2 == 0, "web").otherwise("app").alias("source"),
        F.when(e % 3 == 0, "mobile").when(e % 3 == 1, "desktop").otherwise("tablet").alias("device"),
        F.when(e % 2 == 0, "chrome").otherwise("safari").alias("browser"),
        F.when(u % 5 == 0, "google").when(u % 5 == 1, "facebook").otherwise("direct").alias("utm_source"),
        F.concat(F.lit("camp-"), _txt(u % 4)).alias("utm_campaign"),
        _seq("events", e).alias(SEQ))
    return conform_raw(df, schemas.RAW_CART_EVENT)


def raw_mercury_transactions(customer: DataFrame) -> DataFrame:
    """Bank records: USD balance as amount; VND given for odd keys only."""
    c, bal = F.col("c_custkey"), F.col("c_acctbal")
    when_ts = F.lit("1994-12-01").cast("timestamp_ntz") + F.make_interval(days=c.cast("int"))
    df = customer.select(
        F.concat(F.lit("MT-"), _txt(c)).alias("transaction_id"),
        F.concat(F.lit("acct-"), _txt(c % 3)).alias("accountId"),
        _txt(bal).alias("amount"),
        F.when(c % 2 == 0, _txt(bal)).alias("amount_usd"),
        F.when(c % 2 == 0, F.lit("0")).otherwise(_txt((F.abs(bal) * F.lit(USD_TO_VND_RATE)).try_cast("bigint")))
         .alias("amount_vnd"),
        F.when(bal < 0, "outgoing").otherwise("incoming").alias("kind"),
        F.when(c % 3 == 0, "posted").when(c % 3 == 1, "pending").otherwise("failed").alias("status"),
        F.concat(F.lit("Transfer "), _txt(c)).alias("bankDescription"),
        F.when(c % 17 != 0, _iso_z(when_ts)).alias("createdAt"),
        F.when(c % 17 == 0, _iso_z(when_ts)).alias("postedAt"),
        F.struct(F.when(c % 10 != 0, F.col("c_name")).alias("counterpartyName")).alias("details"),
        _seq("customer", c).alias(SEQ))
    return conform_raw(df, schemas.RAW_MERCURY_TXN)


def raw_customers(customer: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    created = F.lit("1994-01-01").cast("timestamp_ntz") + F.make_interval(days=(c % 365).cast("int"))
    df = customer.select(
        _txt(c).alias("id"),
        F.when(c % 100 != 7, F.concat(F.lit("user"), _txt(c), F.lit("@example.com"))).alias("email"),
        F.col("c_name").alias("name"), F.concat(F.lit("+84"), F.lpad(_txt(c), 9, "0")).alias("phone"),
        F.concat(F.lit("City-"), _txt("c_nationkey")).alias("city"), F.lit("VN").alias("country"),
        F.date_format(created, "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        _seq("customer", c).alias(SEQ))
    return conform_raw(df, schemas.RAW_CUSTOMER)


def raw_products(part: DataFrame) -> DataFrame:
    p = F.col("p_partkey")
    df = part.select(
        _txt(p).alias("id"), F.col("p_name").alias("name"), F.concat(F.lit("SKU-"), _txt(p)).alias("sku"),
        F.concat(F.lit("893"), F.lpad(_txt(p), 10, "0")).alias("barcode"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
        _txt(_vnd(F.col("p_retailprice"))).alias("price_vnd"), _txt("p_retailprice").alias("price_usd"),
        _txt(F.col("p_size") * 10).alias("stock_quantity"), _seq("part", p).alias(SEQ))
    return conform_raw(df, schemas.RAW_PRODUCT)


def raw_locations(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Stores from nations; the city is the region name."""
    j = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
    n = F.col("n_nationkey")
    df = j.select(
        _txt(n).alias("id"), F.concat(F.lit("LOC-"), _txt(n)).alias("code"),
        F.col("n_name").alias("name"), F.concat(F.col("n_name"), F.lit(" street")).alias("address"),
        F.col("r_name").alias("city"), F.concat(F.lit("028"), F.lpad(_txt(n), 7, "0")).alias("phone"),
        _seq("nation", n).alias(SEQ))
    return conform_raw(df, schemas.RAW_LOCATION)
