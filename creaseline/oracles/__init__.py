"""SQL twins of the queries, for an engine that has the test tables as views."""

from creaseline.oracles import frame_sql, live_sql, match_sql, report_sql

ORACLES: dict[str, str] = {**report_sql.SQL, **frame_sql.SQL, **match_sql.SQL, **live_sql.SQL}
