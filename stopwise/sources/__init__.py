from .pings import read_ping_history, read_ping_stream
from .tables import load_model, read_live_status, read_training, save_model, write_table
from .timetable import Timetable, read_timetable

__all__ = ["Timetable", "load_model", "read_live_status", "read_ping_history",
           "read_ping_stream", "read_timetable", "read_training", "save_model", "write_table"]
