from varspark.functions import evidence, text

__all__ = ["evidence", "text"]
