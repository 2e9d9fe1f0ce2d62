"""tripstar — a Spark-native trip-analytics lakehouse.

Raw monthly trip files and a zone lookup are loaded idempotently, standardised
into bronze and silver DataFrames, modelled as a star schema (one fact, eleven
dimensions) in gold, checked with declarative data tests, and queried by a set
of business questions.  Every transformation is a ``DataFrame -> DataFrame``
function; writers live in :mod:`tripstar.plans`.

Entry points:

* ``plans.loader.load_service`` / ``load_zones`` — month files and lookup -> raw tables;
* ``plans.layers.Lakehouse`` + ``run_pipeline`` — raw -> bronze -> silver -> gold tables;
* ``operators.analytics`` / ``plans.questions`` — the business questions (DataFrame / SQL);
* ``operators.quality`` — data tests and the gate;
* ``python -m tripstar load|build|query`` — the same from the command line.
"""

__all__ = ["session", "config", "schemas"]
