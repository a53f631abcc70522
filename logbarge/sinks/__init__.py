from .files import file_transport, read_labelled, write_label_index, write_payloads
from .ledger import Ledger
from .push import PushOptions, push_attempts, push_attempts_stream, push_sink, write_push

__all__ = ["Ledger", "PushOptions", "file_transport", "push_attempts", "push_attempts_stream", "push_sink", "read_labelled", "write_label_index", "write_payloads", "write_push"]
