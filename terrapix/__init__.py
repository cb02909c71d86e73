"""terrapix: labelled satellite-pixel analytics as Spark jobs.

Layout
------
``sources``    readers/writers (parquet pixels, parcels, class map, JSON/Kafka
               messages, GeoPackage data source, NPZ patches, object inventory)
``functions``  Column expressions (band scaling, normalised differences,
               hash-uniform numbers, status groups, UTM projection, ...)
``operators``  DataFrame -> DataFrame operators (grid range join, scene
               matching, patch explode/pack/resample/rasterize, sampling,
               metrics, profiling, monitor aggregates, ordering helpers)
``plans``      end-to-end jobs composed from operators (task generation,
               patch production, training/evaluation)
``streaming``  Structured Streaming versions of the patch and monitor loops
"""

from terrapix.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
