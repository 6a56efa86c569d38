from corpusflow.functions import text, values

__all__ = ["text", "values"]
