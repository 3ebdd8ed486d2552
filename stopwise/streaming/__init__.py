from .kept import KeptTable, newest, totals
from .late import LateRows
from .sinks import compact_sink, read_sink, run_available, start_query
from .vehicle import follow_vehicles, finish_vehicles

__all__ = ["KeptTable", "LateRows", "compact_sink", "finish_vehicles", "follow_vehicles", "newest", "read_sink",
           "run_available", "start_query", "totals"]
