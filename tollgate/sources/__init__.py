from .files import (
    anti_manifest,
    load_new,
    new_files,
    read_clean,
    read_raw,
    scan_text,
    write_clean,
)
from .kafka import read_kafka, write_kafka
from .logs import compact_load, log_progress, log_run, read_load, read_log
from .models import load_model, save_model

__all__ = [
    "anti_manifest",
    "compact_load",
    "load_model",
    "load_new",
    "log_progress",
    "log_run",
    "new_files",
    "read_clean",
    "read_kafka",
    "read_load",
    "read_log",
    "read_raw",
    "save_model",
    "scan_text",
    "write_clean",
    "write_kafka",
]
