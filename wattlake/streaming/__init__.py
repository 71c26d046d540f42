from wattlake.streaming.arrivals import process_arrivals

__all__ = ["process_arrivals"]
