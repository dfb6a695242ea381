"""Hosts judged against their prior: a small host among many that agree, and hosts that are rejected, by SQL too."""

import duckdb
import pytest

from martwise.llm import quality_rules
from martwise.llm.common import ship
from martwise.llm.oracle import SQL
from martwise.llm.queries import QUERIES

SCORED = "source string, base_failed boolean, symbols_failed boolean, lines_failed boolean"


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


def test_a_small_host_is_drawn_to_hosts_that_agree(shipped):
    rows = [(f"h{h}", k == 0, False, False) for h in range(100) for k in range(10)] + [("one", True, False, False)]
    got = {r["host"]: r for r in quality_rules.host_verdicts(shipped.createDataFrame(rows, SCORED)).collect()}
    assert got["one"]["base_failed_rate"] == pytest.approx(101 / 1001, abs=0.005)  # no evidence that hosts differ
    assert not any(r["host_rejected"] for r in got.values())


def test_unlike_hosts_are_judged_by_their_own_documents(shipped):
    rows = [(f"h{h}", k < 10 * (h % 2), False, False) for h in range(40) for k in range(10)]
    got = {r["host"]: r for r in quality_rules.host_verdicts(shipped.createDataFrame(rows, SCORED)).collect()}
    assert got["h1"]["base_failed_rate"] > 0.9 and got["h0"]["base_failed_rate"] < 0.1
    assert got["h1"]["host_rejected"] and not got["h0"]["host_rejected"]


def test_rejected_hosts_equal_the_sql(shipped, tmp_path):
    def good(k):
        return " ".join(f"w{k}x{i}" for i in range(70))

    def marked(k):  # long enough, but full of symbols
        return good(k) + " " + "# " * 40

    rows, k = [], 0
    for host in range(12):
        for i in range(30):
            k += 1
            text = marked(k) if host in (3, 7) and i < 28 or i % 9 == 0 else "few words" if i % 10 == 1 else good(k)
            rows.append((k, f"host{host}", text))
    rows += [(1000, "tiny", marked(1000)), (1001, None, good(1001)), (1002, "host3", None), (1003, "host3", good(1003))]
    shipped.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["op2_quality_rules"](shipped, str(tmp_path))
    got = sorted((tuple(r) for r in out.collect()), key=str)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = sorted(db.execute(SQL["op2_quality_rules"]).fetchall(), key=str)
    assert got == want
    host = {k: s for k, s, _ in rows}
    rejected = {host[r[0]] for r in got if not r[6] and not r[7]}
    assert rejected == {"host3", "host7"} and not any(r[7] for r in got if host[r[0]] in rejected)
