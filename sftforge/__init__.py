"""sftforge: Spark-native jobs that build, prepare and audit bracket-completion SFT data.

Every public operator is a ``DataFrame -> DataFrame`` function built from Spark
built-ins (expressions, higher-order functions, windows, joins, aggregates).
Sub-packages:

- ``functions``: column expressions and fixed values (templates, patterns, hash draws)
- ``sources``: conversation / task readers and writers, turn-table fold, table loading
- ``operators``: the jobs (synthesis, bracket analytics, chat, tokens, examples,
  ordering, lengths, losses, run logs, responses)
- ``plans``: registered queries and their DuckDB oracle SQL
- ``streaming``: the row-wise conversation audit over a file stream
"""

from sftforge.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
