"""Season and feature-family parameters.

Every pivot in the library takes its values from here, so each output schema
is fixed up front and no distinct-values job is run to discover columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from . import constants as K


def season_label(start_year: int) -> str:
    """'2013-2014' style label for the season starting in ``start_year``."""
    return f"{start_year}-{start_year + 1}"


def suffix(season: str) -> str:
    """Column-name suffix of a season: only the first hyphen becomes '_'."""
    return season.replace("-", "_", 1)


@dataclass(frozen=True)
class HistorySpec:
    """Which seasons, sets and composers the feature table is built over."""

    history_seasons: tuple[str, ...]          # oldest -> newest, target excluded
    target_season: str
    ticket_seasons: tuple[str, ...]           # also attendance / programme window
    ticket_sets: tuple[str, ...]
    composers: tuple[str, ...]                # programme columns
    preference_composers: tuple[str, ...]     # kept as conc_<c>
    missed_composers: tuple[str, ...]         # kept as conc_missed_<c>
    reference_year: int                       # "now" for years_donating
    window_years: tuple[int, ...] = K.WINDOW_YEARS
    subs_numeric: tuple[str, ...] = ("price_level", "no_seats", "total")
    subs_factors: tuple[str, ...] = ("package", "location", "section", "multiple_subs")
    ticket_values: tuple[str, ...] = ("price_level", "no_seats")
    invariant_seasons: int = K.INVARIANT_SEASONS   # seasons that must not vary for the invariant rule
    period_months: int = 12                        # months of the driver tables' orders that make one season (binding)
    first_start: int = 1995 + 13                   # start year of the season that begins with January 1995 (binding)
    composer_by: str = "p_type"                    # what names a programme's composer: p_type, or the part's number (binding)

    def __post_init__(self) -> None:
        longest = max(*self.window_years, self.invariant_seasons, len(self.ticket_seasons))
        if longest > len(self.history_seasons):
            raise ValueError(f"windows of {longest} seasons need as many seasons of history, not {len(self.history_seasons)}")

    @property
    def last_season(self) -> str:
        return self.history_seasons[-1]

    def last(self, n: int) -> tuple[str, ...]:
        """The last ``n`` history seasons."""
        if n > len(self.history_seasons):
            raise ValueError(f"{n} seasons asked of a history of {len(self.history_seasons)}")
        return self.history_seasons[-n:]

    @property
    def windows(self) -> tuple[int, ...]:
        return self.window_years


# Order year y of the driver tables is labelled as the season starting in y + SEASON_SHIFT, so that
# the six history years 1995-2000 become the seasons 2008-2009 ... 2013-2014 and 2001 the target
# 2014-2015: the season names (and so every feature-filter regex) are those of the reference.
SEASON_SHIFT = 13


def binding_spec() -> HistorySpec:
    """Spec for the driver-table binding (order years 1995-2001 -> seasons 2008-2009 ... 2014-2015): six seasons of history, so
    the windows end at six seasons and the invariant rule looks at six."""
    hist = tuple(season_label(y + SEASON_SHIFT) for y in range(1995, 2001))
    comps = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    return HistorySpec(
        history_seasons=hist,
        target_season=season_label(2001 + SEASON_SHIFT),
        ticket_seasons=hist[-4:],
        ticket_sets=tuple(str(i) for i in range(1, 8)),
        composers=comps,
        preference_composers=("ECONOMY", "LARGE", "MEDIUM", "PROMO"),
        missed_composers=comps,
        reference_year=2014,
        window_years=tuple(w for w in K.WINDOW_YEARS if w <= len(hist)),
        invariant_seasons=len(hist),
    )


def reference_spec() -> HistorySpec:
    """Spec with the reference's own 18 seasons, windows and composer lists. On the driver tables every four months of orders make a
    season (1995 to April 2001: 1996-1997 ... 2014-2015) and parts stand for composers by their number."""
    hist = tuple(season_label(y) for y in range(1996, 2014))
    # FIXED VALUES: composers kept for preferences and for missed concerts, and all composers of the programme table.
    pref = ("BACH", "HANDEL", "TELEMAN", "JOHANN", "VIVALDI", "HAYDN", "ROSSINI")
    missed = ("BACH", "HANDEL", "TELEMAN", "JOHANN", "VIVALDI", "HAYDN", "ROSSINI", "CORELLI", "PERGOLESI", "MOZART")
    composers = ("MOZART", "HANDEL", "BACH", "TELEMAN", "JOHANN", "CORELLI", "SPHOR", "VIVALDI", "MUFFAT", "BEETHOVEN", "MENDELSSOHN",
                 "HAYDN", "ROSSINI", "PURCELL", "REBEL", "DURANTE", "HUMMEL", "LEVIN", "PERGOLESI", "FASCH", "GREGORI", "GEMINIANI",
                 "LOCKE", "ARNE", "LAWES", "BECK", "SCHUMANN", "BEREZOVSKY", "BORTNIANSKY", "FOMIN", "STANLEY", "CROFT", "BOYCE")
    return HistorySpec(
        history_seasons=hist,
        target_season=season_label(2014),
        ticket_seasons=hist[-4:],
        ticket_sets=tuple(str(i) for i in range(0, 9)),
        composers=composers,
        preference_composers=pref,
        missed_composers=missed,
        reference_year=2014,
        period_months=4,
        first_start=1996,
        composer_by="number",
    )
