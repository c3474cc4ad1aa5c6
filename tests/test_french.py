import random

import pytest

from signalflow.functions.french import french_stem

# Families of words and their stems by the published rules.
SAMPLE = """continu continu, continua continu, continuait continu, continuant continu, continuation continu, continue continu,
continué continu, continuel continuel, continuelle continuel, continuellement continuel, continuelles continuel,
continuels continuel, continuer continu, continuera continu, continuerait continu, continueront continu, continuez continu,
continuité continu, continuons continuon, contorsions contors, contour contour, contournait contourn, contournant contourn,
contourne contourn, contours contour, contractait contract, contracté contract, contractée contract, contracter contract,
contractés contract, contractions contract, contradictoirement contradictoir, contradictoires contradictoir,
contraindre contraindr, contraint contraint, contrainte contraint, contraintes contraint, contraire contrair,
contraires contrair, contraria contrari, main main, mains main, maintenaient mainten, maintenait mainten, maintenant mainten,
maintenir mainten, maintenue maintenu, maintien maintien, maintint maintint, maire mair, maires mair, mairie mair, mais mais,
maïs maï, maison maison, maisons maison, maistre maistr, maitre maitr, maître maîtr, maîtres maîtr, maîtresse maîtress,
maîtresses maîtress, majesté majest, majestueuse majestu, majestueusement majestu, majestueux majestu, majeur majeur,
majeure majeur, major major, majordome majordom, majordomes majordom, majorité major, majorités major, mal mal,
malacca malacc, malade malad, malades malad, maladie malad, maladies malad, maladive malad"""

# One word or more per rule, worked out by hand.
RULES = {
    "regions": "parade parad, colonie colon, tapis tapis, aérer aer, œil œil",
    "marks": "quand quand, jouer jou, ennuie ennui, essaye essay, yeux yeux, croyant croi",
    "plain": "résistance résist, chimique chimiqu, dangereux danger, table tabl",
    "agent": "éducateur éduc, indication indiqu, fabrication fabriqu, opération oper, nation nation",
    "log, u, ent": "biologie biolog, solution solut, révolution révolu, conférence conférent, fréquence fréquenc",
    "ement": "activement activ, relativement relat, heureusement heureux, premièrement premi, rapidement rapid",
    "ité": "responsabilité respons, stabilité stabl, publicité publiqu, activité activ",
    "if": "négatif négat, explicatif expliqu, vive viv",
    "aux, euse": "eaux eau, gâteaux gâteau, chevaux cheval, joyeuse joyeux, peureuse peureux",
    "issement": "établissement établ, remboursement rembours",
    "amment": "constamment const, fréquemment fréquent, vraiment vrai",
    "i-verbs": "finissait fin, choisir chois, sortie sort",
    "verbs": "mangeait mang, parlions parlion, continuions continuion, passions passion, chantèrent chant",
    "residual": "grippes gripp, lion lion, infection infect, premier premi, première premi, aiguë aiguë, contiguë contigu",
    "closing": "ancienne ancien, bonnes bon, lettre lettr, réveille réveil, réveillent réveillent, fièvre fievr, fièvres fievr",
}


def pairs(text):
    return [tuple(p.split()) for p in text.split(",")]


@pytest.mark.parametrize("text", [SAMPLE, *RULES.values()], ids=["sample", *RULES])
def test_stems(spark, text):
    words = spark.createDataFrame(pairs(text), "word string, stem string")
    got = [(r.word, r.got) for r in words.select("word", french_stem(words.word).alias("got")).collect()]
    assert got == pairs(text)


def test_null_empty_and_foreign(spark):
    words = spark.createDataFrame([(None,), ("",), ("s",), ("zzz",), ("日本",), ("é" * 3000,)], "word string")
    got = [r[0] for r in words.select(french_stem(words.word)).collect()]
    assert got[:5] == [None, "", "s", "zzz", "日本"] and got[5] is not None


def test_one_word_in_python_has_the_stem_of_the_expression(spark):
    """Made words: starts and endings of the rules in many regions."""
    from signalflow.functions import french

    rng = random.Random(12)
    endings = " ".join(v for k, v in vars(french).items() if isinstance(v, str) and k.isupper() and k[0] != "_" and len(k) > 1 and k not in ("VOWELS", "RV_PREFIXES")).lower().split()
    parts = [*french.VOWELS, *"bcdlmnpqrstvgyç", "qu", "par", "ic", "iv", "at", "eus", "abil", "abl", "icat", "ièr", "gu", "ell", "enn", "", "iss"]
    made = {"".join(rng.choices(parts, k=rng.randrange(0, 6))) + rng.choice(endings) for _ in range(6000)} | {"", "s", "y", "é", "ions"}
    words = spark.createDataFrame([(w,) for w in sorted(made)], "w string").repartition(8)
    wrong = [(r.w, r.s, french.stem(r.w)) for r in words.select("w", french.french_stem(words.w).alias("s")).collect() if r.s != french.stem(r.w)]
    assert wrong == []
