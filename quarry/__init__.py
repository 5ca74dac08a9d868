"""quarry: lazy DataFrame operators and jobs for medallion-style pipelines on Spark.

Layout (operator IDs as in SURVEY §2):

* ``quarry.session``      session settings, shuffle sizing, shared checkpoint folder
* ``quarry.semantics``    pandas-vs-Spark null/NaN/rounding rules (N-1..N-11)
* ``quarry.functions``    Column -> Column scalars (C*, D1, T*, X*)
* ``quarry.operators``    DataFrame -> DataFrame operators (P*, F*, Q*, J*, A*, W*, O*, U1, K10/K11, M*)
* ``quarry.sources``      scans (S*), ``quarry.sinks`` table writes (K*)
* ``quarry.streaming``    incremental snapshot ingest (ST1)
* ``quarry.plans``        the jobs (bike, books, covid, retail, sales) and the driver query catalog
"""

from quarry.session import apply_semantics, build_session, shuffle_partitions_for

__all__ = ["apply_semantics", "build_session", "shuffle_partitions_for"]
