from corpusflow.operators import hot_keys, telemetry, tokenize, tracking

__all__ = ["hot_keys", "telemetry", "tokenize", "tracking"]
