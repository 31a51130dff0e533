"""orderflow: order-book analytics (quotation -> order -> dispatch -> invoice -> payment)
as Spark DataFrame jobs."""

__all__ = ["params", "vocab"]
