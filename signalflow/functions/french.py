"""French stems by the published Snowball rules, as one column expression.

A word has three regions: RV after its first vowel that does not begin it, R1 after the first consonant behind a
vowel, R2 the same within R1. An ending goes if it lies in the region its rule names. Letters that are vowels by
spelling but not by sound are upper-cased first, so that they count as consonants, and lower-cased at the end.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the algorithm: vowels, prefixes that end before RV, and the endings of each step.
VOWELS = "aeiouyâàëéêèïîôûù"
RV_PREFIXES = "par|col|tap"
PLAIN = "ance iqUe isme able iste eux ances iqUes ismes ables istes"
AGENT = "atrice ateur ation atrices ateurs ations"
LOGY = "logie logies"
USION = "usion ution usions utions"
ENCE = "ence ences"
EMENT = "ement ements"
ITY = "ité ités"
IVE = "if ive ifs ives"
EUSE = "euse euses"
ISSEMENT = "issement issements"
MENT = "ment ments"
VERBS_I = (
    "îmes ît îtes i ie ies ir ira irai iraIent irais irait iras irent irez iriez irions irons iront is issaIent issais "
    "issait issant issante issantes issants isse issent isses issez issiez issions issons it"
)
VERBS_E = "é ée ées és èrent er era erai eraIent erais erait eras erez eriez erions erons eront ez iez"
VERBS_A = "âmes ât âtes a ai aIent ais ait ant ante antes ants as asse assent asses assiez assions"
RESIDUAL = "ion ier ière Ier Ière e ë"

V, C = f"[{VOWELS}]", f"[^{VOWELS}]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _ending(word: Column, *lists: str) -> Column:
    """The longest of the endings, or the empty text: the leftmost match that reaches the end is the longest."""
    return F.regexp_extract(word, f"(?:{'|'.join(' '.join(lists).split())})$", 0)


def _without(word: Column, n: Column | int) -> Column:
    return F.left(word, F.char_length(word) - n)


def _marked(word: Column) -> Column:
    """Upper-case u and i between vowels, y beside a vowel, and u after q, from left to right."""

    def step(done: Column, at: Column) -> Column:
        letter, after = F.substring(word, at, F.lit(1)), F.substring(word, at + 1, F.lit(1)).rlike(V)
        before = done.rlike(f"{V}$")
        sounded = (letter.isin("u", "i") & before & after) | ((letter == "y") & (before | after)) | ((letter == "u") & done.endswith("q"))
        return F.concat(done, F.when(sounded, F.upper(letter)).otherwise(letter))

    places = F.when(word.rlike("[uiy]"), F.sequence(F.lit(1), F.char_length(word)))
    return F.when(places.isNull(), word).otherwise(F.aggregate(places, F.lit(""), step))


def _start(word: Column, pattern: str) -> Column:
    """Length of the part before a region; the whole word where there is none."""
    found = F.char_length(F.regexp_extract(word, pattern, 0))
    return F.when(found > 0, found).otherwise(F.char_length(word))


def _regions(word: Column) -> Column:
    return F.struct(
        F.when(word.rlike(f"^(?:{V}{V}.|{RV_PREFIXES})"), 3).otherwise(_start(word, f"^.{C}*{V}")).alias("rv"),
        _start(word, f"^{C}*{V}+{C}").alias("r1"),
        _start(word, f"^{C}*{V}+{C}+{V}+{C}").alias("r2"),
    )


def _standard(word: Column, at: Column) -> Column:
    """Step 1: the word without a noun, adjective or adverb ending; NULL where no rule applies."""

    def rules(s: Column) -> Column:
        base = F.struct(s.alias("suffix"), _without(word, F.char_length(s)).alias("base"))
        return _let(base, lambda b: by_ending(b["suffix"], b["base"]))

    def by_ending(suffix: Column, base: Column) -> Column:
        p = F.char_length(base)
        rv, r1, r2 = at["rv"], at["r1"], at["r2"]
        one_of = lambda endings: suffix.isin(*endings.split())
        ends = lambda text: base.endswith(text)
        inside = lambda n: p - n >= r2
        less = lambda n, more="": F.concat(_without(base, n), F.lit(more))
        ic = F.when(ends("ic"), F.when(inside(2), less(2)).otherwise(less(2, "iqU")))
        agent = ic.otherwise(base)
        adverb = (
            F.when(ends("ativ") & inside(4), less(4))
            .when(ends("iv") & inside(2), less(2))
            .when(ends("eus") & inside(3), less(3))
            .when(ends("eus") & (p - 3 >= r1), less(3, "eux"))
            .when((ends("abl") | ends("iqU")) & inside(3), less(3))
            .when((ends("ièr") | ends("Ièr")) & (p - 3 >= rv), less(3, "i"))
            .otherwise(base)
        )
        quality = (
            F.when(ends("abil"), F.when(inside(4), less(4)).otherwise(less(4, "abl")))
            .when(ends("ic"), F.when(inside(2), less(2)).otherwise(less(2, "iqU")))
            .when(ends("iv") & inside(2), less(2))
            .otherwise(base)
        )
        able = (
            F.when(ends("icat") & inside(2), F.when(inside(4), less(4)).otherwise(less(4, "iqU")))
            .when(ends("at") & inside(2), less(2))
            .otherwise(base)
        )
        in_r2 = p >= r2
        return (
            F.when(one_of(PLAIN), F.when(in_r2, base))
            .when(one_of(AGENT), F.when(in_r2, agent))
            .when(one_of(LOGY), F.when(in_r2, F.concat(base, F.lit("log"))))
            .when(one_of(USION), F.when(in_r2, F.concat(base, F.lit("u"))))
            .when(one_of(ENCE), F.when(in_r2, F.concat(base, F.lit("ent"))))
            .when(one_of(EMENT), F.when(p >= rv, adverb))
            .when(one_of(ITY), F.when(in_r2, quality))
            .when(one_of(IVE), F.when(in_r2, able))
            .when(suffix == "eaux", F.concat(base, F.lit("eau")))
            .when(suffix == "aux", F.when(p >= r1, F.concat(base, F.lit("al"))))
            .when(one_of(EUSE), F.when(in_r2, base).when(p >= r1, F.concat(base, F.lit("eux"))))
            .when(one_of(ISSEMENT), F.when((p >= r1) & base.rlike(f"{C}$"), base))
        )

    # adverbs in -ment are step 1 too, but end in ``_adverbs``: the longest ending decides which of both it is
    return _let(_ending(word, PLAIN, AGENT, LOGY, USION, ENCE, EMENT, ITY, IVE, "eaux aux", EUSE, ISSEMENT, "amment emment", MENT), rules)


def _adverbs(word: Column, at: Column) -> Column:
    """The last rules of step 1, behind which the verb endings are still tried."""

    def rules(suffix: Column) -> Column:
        p = F.char_length(word) - F.char_length(suffix)
        base = F.left(word, p)
        return (
            F.when(suffix.isin("amment", "emment") & (p >= at["rv"]), F.concat(base, F.when(suffix == "amment", "ant").otherwise("ent")))
            .when(suffix.isin(*MENT.split()) & base.rlike(f"{V}$") & (p - 1 >= at["rv"]), base)
            .otherwise(word)
        )

    return _let(_ending(word, EMENT, ISSEMENT, "amment emment", MENT), rules)


def _verbs(word: Column, at: Column) -> Column:
    """Steps 2a and 2b, within RV: the word without a verb's ending, or NULL."""

    def rules(s: Column) -> Column:
        first = F.char_length(s["tail"]) - F.char_length(s["i"])
        gone_i = F.when((s["i"] != "") & F.left(s["tail"], first).rlike(f"{C}$"), _without(word, F.char_length(s["i"])))
        rest, cut = _without(word, F.char_length(s["other"])), F.char_length(s["other"])
        mute = F.left(s["tail"], F.char_length(s["tail"]) - cut).endswith("e").cast("int")
        other = (
            F.when(s["other"] == "ions", F.when(F.char_length(rest) >= at["r2"], rest))
            .when(s["other"].isin(*VERBS_E.split()), rest)
            .when(s["other"] != "", _without(word, cut + mute))
        )
        return F.coalesce(gone_i, other)

    tail = F.substring(word, at["rv"] + 1, F.char_length(word))
    found = F.struct(tail.alias("tail"), _ending(tail, VERBS_I).alias("i"), _ending(tail, "ions", VERBS_E, VERBS_A).alias("other"))
    return _let(found, rules)


def _residual(word: Column, at: Column) -> Column:
    """Step 4: a plural s, then what is left of an ending within RV."""

    def rules(w: Column) -> Column:
        tail = F.substring(w, at["rv"] + 1, F.char_length(w))
        return _let(_ending(tail, RESIDUAL), lambda s: ending(w, tail, s))

    def ending(w: Column, tail: Column, s: Column) -> Column:
        base = _without(w, F.char_length(s))
        return (
            F.when(s == "ion", F.when((F.char_length(base) >= at["r2"]) & tail.rlike("[st]ion$"), base).otherwise(w))
            .when(s == "e", base)
            .when(s == "ë", F.when(tail.endswith("guë"), base).otherwise(w))
            .when(s != "", F.concat(base, F.lit("i")))
            .otherwise(w)
        )

    return _let(F.when(word.rlike("[^aiouès]s$"), _without(word, 1)).otherwise(word), rules)


def _closing(word: Column) -> Column:
    """Steps 5 and 6: a doubled last letter once, no accent on a last e before consonants."""
    single = F.when(word.rlike("(?:enn|onn|ett|ell|eill)$"), _without(word, 1)).otherwise(word)
    return F.lower(F.regexp_replace(single, f"[éè](?={C}+$)", "e"))


def french_stem(word: Column) -> Column:
    """Stem of a lower-case French word; NULL stays NULL. Meant for distinct words, or the counted rows of a vocabulary."""

    def whole(s: Column) -> Column:
        w, at = s["w"], s["at"]

        def verbal(v: Column) -> Column:
            changed = lambda x: F.regexp_replace(F.regexp_replace(x, "Y$", "i"), "ç$", "c")
            return F.when(v["gone"].isNotNull(), changed(v["gone"])).otherwise(_residual(v["kept"], at))

        def later(kept: Column) -> Column:
            return _let(F.struct(kept.alias("kept"), _verbs(kept, at).alias("gone")), verbal)

        def first(gone: Column) -> Column:
            altered = F.regexp_replace(F.regexp_replace(gone, "Y$", "i"), "ç$", "c")
            return F.when(gone.isNotNull(), altered).otherwise(_let(_adverbs(w, at), later))

        return _let(_let(_standard(w, at), first), _closing)

    return _let(_marked(word), lambda m: _let(F.struct(m.alias("w"), _regions(m).alias("at")), whole))


# The same rules for one word in Python, for the distinct words of a vocabulary: the nested lambdas above are interpreted.
_VOWEL = frozenset(VOWELS)
_RV_START = re.compile(f"{V}{V}.|{RV_PREFIXES}")
_RV, _R1, _R2 = re.compile(f".{C}*{V}"), re.compile(f"{C}*{V}+{C}"), re.compile(f"{C}*{V}+{C}+{V}+{C}")
_DOUBLED, _ACCENT = ("enn", "onn", "ett", "ell", "eill"), re.compile(f"[éè](?={C}+$)")


def _by_length(*lists: str) -> list[tuple[int, frozenset[str]]]:
    endings = " ".join(lists).split()
    return [(n, frozenset(e for e in endings if len(e) == n)) for n in sorted({len(e) for e in endings}, reverse=True)]


_STANDARD_ENDINGS = _by_length(PLAIN, AGENT, LOGY, USION, ENCE, EMENT, ITY, IVE, "eaux aux", EUSE, ISSEMENT, "amment emment", MENT)
_ADVERB_ENDINGS = _by_length(EMENT, ISSEMENT, "amment emment", MENT)
_I_ENDINGS, _OTHER_ENDINGS, _LAST_ENDINGS = _by_length(VERBS_I), _by_length("ions", VERBS_E, VERBS_A), _by_length(RESIDUAL)
_RULE = {e: name for name, text in (("plain", PLAIN), ("agent", AGENT), ("logy", LOGY), ("usion", USION), ("ence", ENCE), ("ement", EMENT),
    ("ity", ITY), ("ive", IVE), ("eaux", "eaux"), ("aux", "aux"), ("euse", EUSE), ("issement", ISSEMENT)) for e in text.split()}
_MENT, _VERB_E = frozenset(MENT.split()), frozenset(VERBS_E.split())


def _longest(word: str, endings: list[tuple[int, frozenset[str]]]) -> str:
    return next((word[-n:] for n, those in endings if word[-n:] in those), "")


def _mark_word(word: str) -> str:
    done = ""
    for at, letter in enumerate(word):
        if letter in "uiy":
            before, after = done[-1:] in _VOWEL, word[at + 1 : at + 2] in _VOWEL
            sounded = (before or after) if letter == "y" else (before and after) or (letter == "u" and done.endswith("q"))
            letter = letter.upper() if sounded else letter
        done += letter
    return done


def _standard_word(word: str, rv: int, r1: int, r2: int) -> str | None:
    suffix = _longest(word, _STANDARD_ENDINGS)
    rule, base = _RULE.get(suffix), word[: len(word) - len(suffix)]
    p = len(base)

    def less(n: int, other: str) -> str:
        return base[:-n] if p - n >= r2 else base[:-n] + other

    if rule == "ement":
        if p < rv:
            return None
        for end, n in (("ativ", 4), ("iv", 2), ("eus", 3)):
            if base.endswith(end) and p - n >= r2:
                return base[:-n]
        if base.endswith("eus") and p - 3 >= r1:
            return base[:-3] + "eux"
        if base.endswith(("abl", "iqU")) and p - 3 >= r2:
            return base[:-3]
        return base[:-3] + "i" if base.endswith(("ièr", "Ièr")) and p - 3 >= rv else base
    if rule == "eaux":
        return base + "eau"
    if rule == "aux":
        return base + "al" if p >= r1 else None
    if rule == "issement":
        return base if p >= r1 and base and base[-1] not in _VOWEL else None
    if rule == "euse" and p < r2:
        return base + "eux" if p >= r1 else None
    if rule is None or p < r2:
        return None
    if rule in ("logy", "usion", "ence"):
        return base + {"logy": "log", "usion": "u", "ence": "ent"}[rule]
    if rule == "ity" and base.endswith("abil"):
        return less(4, "abl")
    if rule in ("agent", "ity") and base.endswith("ic"):
        return less(2, "iqU")
    if rule == "ity" and base.endswith("iv") and p - 2 >= r2:
        return base[:-2]
    if rule == "ive" and base.endswith("icat") and p - 2 >= r2:
        return less(4, "iqU")
    return base[:-2] if rule == "ive" and base.endswith("at") and p - 2 >= r2 else base


def _without_adverb(word: str, rv: int) -> str:
    suffix = _longest(word, _ADVERB_ENDINGS)
    base = word[: len(word) - len(suffix)]
    if suffix in ("amment", "emment") and len(base) >= rv:
        return base + ("ant" if suffix == "amment" else "ent")
    return base if suffix in _MENT and base[-1:] in _VOWEL and len(base) - 1 >= rv else word


def _verb_word(word: str, rv: int, r2: int) -> str | None:
    tail = word[rv:]
    i, other = _longest(tail, _I_ENDINGS), _longest(tail, _OTHER_ENDINGS)
    before = tail[: len(tail) - len(i)]
    if i and before and before[-1] not in _VOWEL:
        return word[: -len(i)]
    if not other:
        return None
    rest = word[: -len(other)]
    if other == "ions":
        return rest if len(rest) >= r2 else None
    return rest[:-1] if other not in _VERB_E and tail[: -len(other)].endswith("e") else rest


def _residual_word(word: str, rv: int, r2: int) -> str:
    if len(word) > 1 and word[-1] == "s" and word[-2] not in "aiouès":
        word = word[:-1]
    tail = word[rv:]
    suffix = _longest(tail, _LAST_ENDINGS)
    base = word[: len(word) - len(suffix)]
    if suffix == "ion":
        return base if len(base) >= r2 and tail.endswith(("sion", "tion")) else word
    if suffix == "ë":
        return base if tail.endswith("guë") else word
    return base if suffix in ("", "e") else base + "i"


def stem(word: str) -> str:
    """Stem of one lower-case French word, equal to :func:`french_stem`."""
    w = _mark_word(word)
    rv, r1, r2 = (m.end() if m else len(w) for m in (_RV.match(w), _R1.match(w), _R2.match(w)))
    if _RV_START.match(w):
        rv = 3
    gone = _standard_word(w, rv, r1, r2)
    if gone is None:
        kept = _without_adverb(w, rv)
        gone = _verb_word(kept, rv, r2)
    if gone is None:
        gone = _residual_word(kept, rv, r2)
    elif gone.endswith(("Y", "ç")):
        gone = gone[:-1] + ("i" if gone[-1] == "Y" else "c")
    if gone.endswith(_DOUBLED):
        gone = gone[:-1]
    return _ACCENT.sub("e", gone).lower()
