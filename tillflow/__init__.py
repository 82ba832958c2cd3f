"""tillflow: Spark-native normalisation of till receipts.

Raw receipt rows (batch files or a stream of arriving files) are cleaned,
given content-hash ids, stripped of personal data, split into item rows and
normalised into four tables (stores, orders, products, orders_products) that
are loaded with insert-if-absent semantics. Everything is a DataFrame plan.
"""

from tillflow.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
