from martwise.streaming.cart_stream import (  # noqa: F401
    cart_event_stream, read_ingested, start_cart_event_ingest,
)
