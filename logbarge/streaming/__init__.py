from .batches import cut_batches_stream, drain_open, next_batches, use_rocksdb
from .parallel import ParallelCut
from .progress import StageTimes, stage_times

__all__ = ["ParallelCut", "StageTimes", "cut_batches_stream", "drain_open", "next_batches", "stage_times", "use_rocksdb"]
