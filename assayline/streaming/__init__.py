from assayline.streaming.landing import compact, land_batch, land_stream

__all__ = ["compact", "land_batch", "land_stream"]
