from trackspark.streaming.incremental import ingest_incremental

from trackspark.streaming.maintained import analyse_maintained, ingest_maintained, maintained_steps, relabel

__all__ = ["analyse_maintained", "ingest_incremental", "ingest_maintained", "maintained_steps", "relabel"]
