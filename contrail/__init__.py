"""contrail: flight and reservation analytics as Spark DataFrame/SQL/Streaming operators.

Subpackages: ``functions`` (Column expressions), ``operators`` (DataFrame
operators), ``plans`` (reports, jobs, dashboard datasets, global ordering),
``sources`` (readers, landing, sinks, snapshots), ``streaming`` (event
streams). ``catalog`` registers one query per operator key.
"""

__version__ = "0.1.0"
