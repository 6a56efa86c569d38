from corpusflow.sources import corpus, device_log

__all__ = ["corpus", "device_log"]
