"""What to compute: keyword groups, languages, countries, targets."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class KeywordGroup:
    """Named set of search keywords; ``column`` is the name of its count column."""

    column: str
    keywords: tuple[str, ...]


@dataclass(frozen=True)
class SignalSpec:
    """One signal series: the posts of a language set against a country's cases."""

    series_id: str
    lang: str
    country_code: str
    symptom: KeywordGroup
    control: KeywordGroup
    age_codes: tuple[str, ...] = ("All", "ALL")
    lang_match: str = "contains"
    smoothing: float = 0.0
    daily_target: str = "ili_incidence"
    # what the nightly forecast predicts, and its kind of model where it isn't the job's
    target: str = "ili_incidence"
    model: str | None = None

    @property
    def groups(self) -> tuple[KeywordGroup, KeywordGroup]:
        return (self.symptom, self.control)


@dataclass(frozen=True)
class Calendar:
    """Date axis: spine bounds (inclusive) and the strict lower cut-off of outputs."""

    start: date
    end: date
    cutoff: date


# Keyword lists of the three language signals.
ILI_KEYWORDS = {
    "fr": ("grippe", "rhume", "fievre", "courbature"),
    "de": ("Grippe", "grippe", "Schnupfen", "Fieber", "Muskelschmerzen"),
    "en": ("flu", "fever", "cough"),
}
CONTROL_KEYWORDS = {
    "fr": ("travail", "demain", "sommeil", "voitures"),
    "de": ("Auto", "morgen", "Arbeit", "arbeiten", "schlafen", "Schlaf"),
    "en": ("car", "tomorrow", "work", "sleep"),
}


def language_spec(lang: str, country_code: str, **options) -> SignalSpec:
    return SignalSpec(
        series_id=lang,
        lang=lang,
        country_code=country_code,
        symptom=KeywordGroup("grippe_posts", ILI_KEYWORDS[lang]),
        control=KeywordGroup("rest_posts", CONTROL_KEYWORDS[lang]),
        **options,
    )


FRANCE = language_spec("fr", "FRA")
GERMANY = language_spec("de", "DEU", smoothing=1.0, daily_target="ari_incidence", target="ari_incidence", model="gbt_restricted")


@dataclass(frozen=True)
class ForecastSpec:
    """Supervised set-up and folds of one forecast."""

    target: str = "ili_incidence"
    lags: int = 2
    horizon: int = 1
    normalize: bool = False
    n_splits: int = 42
    test_size: int = 1
    gap: int = 0
    max_train: int | None = 200
    drop: tuple[str, ...] = ("ili_case", "ari_case", "ili_incidence", "ari_incidence", "ili_pop_cov", "ari_pop_cov")


WEEKLY_FORECAST = ForecastSpec()
DAILY_FORECAST = ForecastSpec(lags=7, n_splits=220)


@dataclass(frozen=True)
class DailyJob:
    """Paths and settings of the nightly run."""

    landing: str
    store: str
    specs: tuple[SignalSpec, ...]
    calendar: Calendar
    forecast: ForecastSpec = field(default_factory=ForecastSpec)
