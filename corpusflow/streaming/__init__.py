from corpusflow.streaming import streams

__all__ = ["streams"]
