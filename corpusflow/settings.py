"""Default values shared by the operators.

Fixed values: these equal the defaults of the training job whose data work is
re-expressed here, so results match without passing any argument.
"""

# corpus and tokenisation
MAX_LENGTH = 2048
SPLIT = "train"
VOCAB_SIZE = 32000
PAD_ID = 0
EOS_ID = 2
SPECIAL_IDS = 3
IGNORE_INDEX = -100

# training order
SEED = 42
WORLD_SIZE = 16
BATCH_PER_DEVICE = 4
GRADIENT_ACCUMULATION = 8
EPOCHS = 3
LOGGING_STEPS = 10
SAVE_STEPS = 500
EVAL_STEPS = 500
SAVE_TOTAL_LIMIT = 3

# telemetry
THROTTLE_SECONDS = 5
BLOCK_SIZE = 10
DEVICE_FIELDS = 8

# keys of the run parameters
PARAM_KEYS = (
    "model_name",
    "dataset_name",
    "num_epochs",
    "learning_rate",
    "batch_size_per_device",
    "gradient_accumulation_steps",
    "world_size",
    "num_gpus",
)

# metric keys: column of a wide table -> key of the long one
SYSTEM_METRICS = {
    "cpu_percent": "system/cpu_percent",
    "memory_percent": "system/memory_percent",
    "gpu_utilization": "system/gpu_utilization",
    "gpu_memory_gb": "system/gpu_memory_gb",
    "gpu_memory_reserved_gb": "system/gpu_memory_reserved_gb",
}
BLOCK_METRICS = {"block_mean": "training/avg_gpu_utilization"}
FINAL_METRICS = {
    "avg_utilization": "training/final_avg_gpu_utilization",
    "min_utilization": "training/min_gpu_utilization",
    "max_utilization": "training/max_gpu_utilization",
}
BEFORE_LENGTH = "evaluation/before_training_length"
AFTER_LENGTH = "evaluation/after_training_length"

# A key with more rows than this is worked on in several tasks (see operators.hot_keys).
ROWS_PER_CHUNK = 1_000_000
