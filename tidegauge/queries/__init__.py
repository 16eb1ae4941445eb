"""The registered queries, each beside the SQL that must give the same rows."""

from tidegauge.queries import followers, incremental, profiles, settled, streams

MODULES = (profiles, incremental, streams, settled, followers)
