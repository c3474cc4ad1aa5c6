"""Annotation of posts: rules as column expressions, or a caller's function in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalflow.functions.text import joined

HINT_SCHEMA = "uri string, ili_related boolean, symptoms array<string>, error string"


@dataclass(frozen=True)
class Lexicon:
    """Case definition: the words that stand for each of its parts (regular expressions allowed)."""

    first_person: tuple[str, ...]
    fever: tuple[str, ...]
    respiratory: tuple[str, ...]
    systemic: tuple[str, ...]
    other_cause: tuple[str, ...] = ()
    others: tuple[str, ...] = ()
    subject: tuple[str, ...] = ()


# Case definition (own illness with fever, cough or sore throat, and a
# systemic symptom) in English, French and German. "flu" by itself is no symptom.
DEFAULT_LEXICON = Lexicon(
    first_person=("i", "i'm", "i've", "me", "my", "je", "j'ai", "moi", "mon", "ma", "mes", "ich", "mir", "mich", "mein", "meine"),
    fever=("fever", "feverish", "febrile", "temperature", "fièvre", "fievre", "température", "fieber", "erhöhte temperatur"),
    respiratory=("cough", "coughing", "sore throat", "toux", "tousse", "mal de gorge", "mal à la gorge", "husten", "halsschmerzen", "halsweh"),
    systemic=(
        "headache", "muscle aches?", "body aches?", "chills", "fatigue", "tired", "congestion", "stuffy nose",
        "mal de tête", "mal à la tête", "courbatures?", "frissons", "fatiguée?", "nez bouché",
        "kopfschmerzen", "muskelschmerzen", "gliederschmerzen", "schüttelfrost", "müde", "müdigkeit", "schnupfen",
    ),
    other_cause=("allergy", "allergies", "hay fever", "covid", "covid-19", "allergie", "rhume des foins", "heuschnupfen"),
    # somebody near is ill ("my son has fever"), unless the writer also speaks as the subject
    subject=("i", "i'm", "i've", "je", "j'ai", "ich"),
    others=(
        "(?:my|our) (?:\\w+ )?(?:son|daughter|kids?|child|children|baby|toddler|husband|wife|partner|boyfriend|girlfriend|mum|mom|mother|dad|father|brother|sister|friend|colleague|boss|dog|cat)s?",
        "(?:mon|ma|mes|notre|nos) (?:\\w+ )?(?:fils|fille|filles|enfants?|bébé|mari|femme|copain|copine|mère|père|maman|papa|frère|sœur|soeur|amie?s?|collègues?|chien|chat)",
        "(?:mein|meine|meinem|meiner|meinen|unser|unsere) (?:\\w+ )?(?:sohn|tochter|kind|kinder|baby|mann|frau|partner|partnerin|freund|freundin|mutter|vater|mama|papa|bruder|schwester|kollege|kollegin|hund|katze)",
    ),
)
DURATION = r"(?iU)\b(\d+\s+(?:days?|weeks?|jours?|semaines?|tage?n?|wochen?))\b"


def _pattern(terms: tuple[str, ...]) -> str:
    longest_first = sorted(terms, key=lambda t: (-len(t), t))
    return rf"(?iU)(?<![\p{{L}}\p{{N}}])({'|'.join(longest_first)})(?![\p{{L}}\p{{N}}])"


def _has(text: Column, terms: tuple[str, ...]) -> Column:
    return text.rlike(_pattern(terms)) if terms else F.lit(False)


def rule_annotation(posts: DataFrame, text: str = "record__text", lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """``(uri, ili_related, symptoms, duration, error)`` by the case definition.

    Symptoms are the exact words of the text, in order of appearance, listed for every post.
    """
    body = F.col(text)
    symptoms = F.regexp_extract_all(body, F.lit(_pattern(lexicon.fever + lexicon.respiratory + lexicon.systemic)), F.lit(1))
    related = (
        _has(body, lexicon.first_person)
        & _has(body, lexicon.fever)
        & _has(body, lexicon.respiratory)
        & _has(body, lexicon.systemic)
        & ~_has(body, lexicon.other_cause)
        & ~(_has(body, lexicon.others) & ~_has(body, lexicon.subject))
    )
    return posts.select(
        "uri",
        F.coalesce(related, F.lit(False)).alias("ili_related"),
        F.coalesce(symptoms, F.array().cast("array<string>")).alias("symptoms"),
        F.nullif(F.regexp_extract(body, DURATION, 1), F.lit("")).alias("duration"),
        F.lit(None).cast("string").alias("error"),
    )


def annotate(posts: DataFrame, fn: Callable[[str], dict], text: str = "record__text") -> DataFrame:
    """Annotate with a function ``text -> {"ili_related": bool, "symptoms": [str]}``.

    It runs inside the tasks on Arrow batches. A failing row is returned with its
    ``error``, is not stored, and so comes up again in the next run.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for uri, body in zip(batch["uri"], batch[text]):
                try:
                    answer = fn(body)
                    rows.append((uri, bool(answer["ili_related"]), list(answer["symptoms"]), None))
                except Exception as exc:  # one bad row must not fail the batch
                    rows.append((uri, None, None, f"{type(exc).__name__}: {exc}"))
            yield pd.DataFrame(rows, columns=["uri", "ili_related", "symptoms", "error"])

    return posts.select("uri", text).mapInPandas(run, HINT_SCHEMA)


def hint_rows(annotations: DataFrame) -> DataFrame:
    """Rows to merge into the hint table: successes only, symptoms as comma-joined text."""
    return annotations.filter("error is null").select("uri", "ili_related", joined("symptoms").alias("symptoms"))
