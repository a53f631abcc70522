from .events import EventMapping, read_events, stream_events
from .payloads import read_payloads
from .protobuf import read_proto_payloads

__all__ = ["EventMapping", "read_events", "read_payloads", "read_proto_payloads", "stream_events"]
