import pytest

from signalflow.operators import annotate as ops

TEXTS = {
    "own": "Had to leave choir early, I have chills and a sore throat since Monday, 4 days now and a cough on top, plus fever",
    "news": "The pharmacy on our street sells flu tea this week",
    "other": "My son... no: the neighbour has fever, cough and chills",
    "both": "I caught it from my son: fever, cough and chills",
    "third": "She has fever, cough and chills",
    "fils": "Mon petit fils a de la fièvre, il tousse, des courbatures",
    "kind": "Mein Kind hat Fieber, Husten und Kopfschmerzen",
    "nofever": "I have a cough and a headache",
    "covid": "I have fever, cough and chills, covid again",
    "fr": "J'ai de la fièvre, je tousse et j'ai des courbatures depuis 3 jours",
    "de": "Ich habe Fieber, Husten und Kopfschmerzen",
    "empty": None,
}


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(list(TEXTS.items()), "uri string, record__text string")


def test_rules(posts):
    got = {r.uri: r for r in ops.rule_annotation(posts).collect()}
    assert {u for u, r in got.items() if r.ili_related} == {"own", "both", "fr", "de"}
    assert got["own"].symptoms == ["chills", "sore throat", "cough", "fever"] and got["own"].duration == "4 days"
    assert got["news"].symptoms == [] and got["news"].duration is None
    assert got["fr"].symptoms == ["fièvre", "tousse", "courbatures"] and got["fr"].duration == "3 jours"
    assert got["third"].symptoms == ["fever", "cough", "chills"]
    assert got["empty"].symptoms == [] and got["empty"].ili_related is False


def test_function_errors_stay_pending(posts, rows):
    def fn(text):
        if "flu" in text or "choir" in text:
            raise RuntimeError("service down")
        return {"ili_related": True, "symptoms": ["a", "b"]}

    got = ops.annotate(posts.filter("record__text is not null"), fn)
    failed = {r.uri: r.error for r in got.filter("error is not null").collect()}
    assert failed == {"own": "RuntimeError: service down", "news": "RuntimeError: service down"}
    stored = ops.hint_rows(got)
    assert stored.count() == 9 and stored.first().symptoms == "a,b"
