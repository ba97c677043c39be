"""switchboard: contact-centre warehouse operators on Spark DataFrames.

Subpackages: ``sources`` (readers), ``functions`` (column expressions),
``operators`` (aggregates, joins, history, sessions, roll-ups, layouts,
checks), ``streaming`` (refresh on arrival), ``plans`` (test-table bindings,
warehouse tables and the registered queries).
"""

__version__ = "0.1.0"
