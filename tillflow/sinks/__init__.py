"""Writers: processed CSV, table loads, schema conformance, raw landing (K1-K9)."""
