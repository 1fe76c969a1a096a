from assayline.sinks.warehouse import Warehouse

__all__ = ["Warehouse"]
