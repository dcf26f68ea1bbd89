"""starmart: trip records -> star schema -> marts, checks and profiles on Spark.

Every transformation is a plain ``DataFrame -> DataFrame`` function built from
DataFrame/SQL operators; there are no UDFs. Sub-packages:

- ``sources``   readers, column normalisation, the trips adapter
- ``functions`` column expressions (date parts, durations, payment decoding)
- ``operators`` dense keys, dimensions, facts, marts, checks, profiles
- ``sinks``     table writes and CSV/JSON exports
- ``plans``     composed entry points (extract, build_star, publish, run)
"""

__version__ = "0.1.0"
