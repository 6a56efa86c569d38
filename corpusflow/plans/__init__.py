from corpusflow.plans import order

__all__ = ["order"]
