"""Display labels: flags, short names, badges."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from creaseline.functions.rates import _col

# Flag of a team.
TEAM_FLAGS = {
    "Afghanistan": "🇦🇫", "Australia": "🇦🇺", "Bangladesh": "🇧🇩", "Canada": "🇨🇦", "England": "🏴",
    "India": "🇮🇳", "Ireland": "🇮🇪", "Italy": "🇮🇹", "Namibia": "🇳🇦", "Nepal": "🇳🇵",
    "Netherlands": "🇳🇱", "New Zealand": "🇳🇿", "Oman": "🇴🇲", "Pakistan": "🇵🇰", "Scotland": "🏴",
    "South Africa": "🇿🇦", "Sri Lanka": "🇱🇰", "United Arab Emirates": "🇦🇪",
    "United States of America": "🇺🇸", "West Indies": "🏝️", "Zimbabwe": "🇿🇼",
}
UNKNOWN_FLAG = "🏳️"

# Short name of a team, where it has one.
TEAM_SHORT = {
    "United Arab Emirates": "UAE", "United States of America": "USA", "South Africa": "SA",
    "New Zealand": "NZ", "Sri Lanka": "SL", "West Indies": "WI",
}


def _lookup(table: dict[str, str], key: Column) -> Column:
    literal = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(literal, key)


def team_flag(team, unknown: str = UNKNOWN_FLAG) -> Column:
    return F.coalesce(_lookup(TEAM_FLAGS, _col(team)), F.lit(unknown))


def team_short(team) -> Column:
    return F.coalesce(_lookup(TEAM_SHORT, _col(team)), _col(team))


def with_flag(flag: Column, name) -> Column:
    """'flag name', or the bare name when there is no flag."""
    return F.when(flag != "", F.concat_ws(" ", flag, _col(name))).otherwise(_col(name))


def pair_label(left, right, joiner: str) -> Column:
    return F.concat(_col(left), F.lit(f" {joiner} "), _col(right))


def status_badge(status) -> Column:
    text = F.lower(_col(status))
    return (F.when(text.rlike("won|result"), "finished")
             .when(text.rlike("live|progress|play|break"), "live")
             .otherwise("info"))


def match_state(started, ended) -> Column:
    s, e = F.coalesce(_col(started), F.lit(False)), F.coalesce(_col(ended), F.lit(False))
    return F.when(e, "Done").when(s, "Live").otherwise("Soon")


def toss_advantage(win_pct) -> Column:
    return F.when(_col(win_pct) > 50, "advantage").otherwise("no advantage")
