"""quillprice: part-price derivation and price comparison on Spark DataFrames."""

__all__ = ["session"]
