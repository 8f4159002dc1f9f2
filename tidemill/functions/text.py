"""Text normalisation, keywords, answers and prices as JVM expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill import fixed_values as fv

PUNCTUATION = r"[!-/:-@\[-`{-~]"


def fold_accents(s: Column) -> Column:
    """Lower case, trimmed, accents removed by the fixed table."""
    return F.translate(F.lower(F.trim(s)), fv.ACCENTS_FROM, fv.ACCENTS_TO)


def strip_punctuation(s: Column) -> Column:
    """Drops ASCII punctuation (Spanish opening marks stay) and squeezes white space."""
    return F.regexp_replace(F.regexp_replace(s, PUNCTUATION, ""), r"\s+", " ")


def normalise(s: Column) -> Column:
    return strip_punctuation(fold_accents(s))


def fold_word(word: str) -> str:
    return word.lower().translate(str.maketrans(fv.ACCENTS_FROM, fv.ACCENTS_TO))


def stopwords(language: str = "spanish", extra: Sequence[str] = tuple(fv.EXTRA_STOPWORDS), fold: bool = True) -> list[str]:
    """Spark's own stopword list plus domain words. Texts are folded before the test, so the list is
    folded too; ``fold=False`` keeps accented stopwords in the text, which then survive."""
    from pyspark.ml.feature import StopWordsRemover

    words = {*StopWordsRemover.loadDefaultStopWords(language), *extra}
    return sorted({fold_word(w) for w in words} if fold else words)


def keywords(s: Column, stop: Sequence[str]) -> Column:
    """Tokens that are alphabetic, no stopword and longer than two letters."""
    words = F.regexp_extract_all(normalise(s), F.lit(r"(?<![^ ])(\p{L}{3,})(?![^ ])"), F.lit(1))
    return F.filter(words, lambda t: ~t.isin(list(stop))) if stop else words


# The endings of the Snowball stemmer for Spanish, by step and by what is done about them.
VOWELS = "aeiouáéíóúü"
PRONOUNS = "me se sela selo selas selos la le lo las les los nos".split()
PRONOUN_HOSTS = "iéndo ándo ár ér ír ando iendo ar er ir yendo".split()
STANDARD = {
    "plain": "anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos imiento imientos".split(),
    "ic": "adora ador ación adoras adores aciones ante antes ancia ancias".split(),
    "log": "logía logías".split(),
    "u": "ución uciones".split(),
    "ente": "encia encias".split(),
    "amente": ["amente"],
    "mente": ["mente"],
    "idad": "idad idades".split(),
    "iv": "iva ivo ivas ivos".split(),
}
Y_VERBS = "ya ye yan yen yeron yendo yo yó yas yes yais yamos".split()
GU_VERBS = "en es éis emos".split()
VERBS = (
    "arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos eremos erá eré "
    "irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id ase iese aste iste an aban ían "
    "aran ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis abais íais "
    "arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos iésemos ásemos"
).split()
RESIDUAL, RESIDUAL_E = "os a o á í ó".split(), "e é".split()
ACCENTS = ("áéíóú", "aeiou")
#: Up to the begin of the regions R1 (after the first consonant that follows a vowel) and RV.
R1 = f"^.*?[{VOWELS}][^{VOWELS}]"
RV = f"^(?:.[^{VOWELS}].*?[{VOWELS}]|[{VOWELS}][{VOWELS}].*?[^{VOWELS}]|[^{VOWELS}][{VOWELS}].)"


def ending(options: Sequence[str]) -> str:
    """A pattern that finds the longest of the endings: the one that begins first."""
    return f"(?:{'|'.join(options)})$"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value under a name, so that it is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _cut(word: Column, n: Column | int) -> Column:
    return F.left(word, F.length(word) - n)


def _found(word: Column, options: Sequence[str]) -> Column:
    return F.regexp_extract(word, ending(options), 0)


def _after(word: Column, pattern: str) -> Column:
    """Where a region begins; a word without the region has it at its end."""
    head = F.length(F.regexp_extract(word, pattern, 0))
    return F.when(head > 0, head).otherwise(F.length(word))


def _without(word: Column, options: Sequence[str], start: Column) -> Column:
    """The word without the longest of the endings, if that lies in the region from ``start``."""
    return _let(_found(word, options), lambda e: F.when((e != "") & (F.length(word) - F.length(e) >= start), _cut(word, F.length(e))).otherwise(word))


def _attached_pronoun(w: Column, r: Column) -> Column:
    def cut(pair: Column) -> Column:
        rest, host = pair["rest"], pair["host"]
        fits = (host != "") & (F.length(rest) - F.length(host) >= r["rv"])
        fits = fits & ((host != "yendo") | (F.substring(rest, -6, 1) == "u"))
        accent = host.isin("iéndo", "ándo", "ár", "ér", "ír")
        plain = F.concat(_cut(rest, F.length(host)), F.translate(host, *ACCENTS))
        return F.when((pair["pronoun"] == "") | ~fits, w).when(accent, plain).otherwise(rest)

    rest = _let(_found(w, PRONOUNS), lambda p: F.struct(p.alias("pronoun"), _cut(w, F.length(p)).alias("rest")))
    return _let(_let(rest, lambda x: F.struct(x["pronoun"].alias("pronoun"), x["rest"].alias("rest"), _found(x["rest"], PRONOUN_HOSTS).alias("host"))), cut)


def _standard(w: Column, r: Column) -> Column:
    """The word after the first step, null if no ending went."""
    every = [e for group in STANDARD.values() for e in group]
    two = r["r2"]

    def act(e: Column) -> Column:
        def of(name: str) -> Column:
            return e.isin(STANDARD[name])

        def then(rest: Column) -> Column:
            iv = _let(_without(rest, ["iv"], two), lambda x: F.when(x == rest, _without(rest, ["os", "ic", "ad"], two)).otherwise(_without(x, ["at"], two)))
            return (
                F.when(of("plain"), rest).when(of("ic"), _without(rest, ["ic"], two)).when(of("log"), F.concat(rest, F.lit("log")))
                .when(of("u"), F.concat(rest, F.lit("u"))).when(of("ente"), F.concat(rest, F.lit("ente"))).when(of("amente"), iv)
                .when(of("mente"), _without(rest, ["ante", "able", "ible"], two)).when(of("idad"), _without(rest, ["abil", "ic", "iv"], two))
                .otherwise(_without(rest, ["at"], two))
            )

        begin = F.length(w) - F.length(e)
        fits = (e != "") & (begin >= F.when(of("amente"), r["r1"]).otherwise(two))
        return F.when(fits, _let(_cut(w, F.length(e)), then))

    return _let(_found(w, every), act)


def _verb(w: Column, r: Column) -> Column:
    tail = F.substring(w, r["rv"] + 1, F.length(w))

    def y(e: Column) -> Column:
        return F.when((e != "") & F.endswith(_cut(w, F.length(e)), F.lit("u")), _cut(w, F.length(e)))

    def other(e: Column) -> Column:
        rest = _cut(w, F.length(e))
        gu = e.isin(GU_VERBS) & F.endswith(rest, F.lit("gu"))
        return F.when(gu, _cut(rest, 1)).otherwise(rest)

    return F.coalesce(_let(_found(tail, Y_VERBS), y), _let(_found(tail, GU_VERBS + VERBS), other))


def _residual(w: Column, r: Column) -> Column:
    def act(e: Column) -> Column:
        rest = _cut(w, F.length(e))
        gu = e.isin(RESIDUAL_E) & F.endswith(rest, F.lit("gu")) & (F.length(rest) - 1 >= r["rv"])
        return F.when((e == "") | (F.length(rest) < r["rv"]), w).when(gu, _cut(rest, 1)).otherwise(rest)

    return _let(_found(w, RESIDUAL + RESIDUAL_E), act)


def stem_word(word: Column) -> Column:
    """The stem of one lower-case word by the Snowball rules for Spanish; accents go at the end."""
    def regions(w: Column) -> Column:
        r1 = _let(_after(w, R1), lambda n: F.struct(n.alias("r1"), (n + _after(F.substring(w, n + 1, F.length(w)), R1)).alias("r2")))
        return _let(r1, lambda x: F.struct(x["r1"].alias("r1"), x["r2"].alias("r2"), _after(w, RV).alias("rv")))

    def steps(w: Column) -> Column:
        def from_regions(r: Column) -> Column:
            bare = _let(_attached_pronoun(w, r), lambda x: F.coalesce(_standard(x, r), _verb(x, r)))
            return F.translate(_let(bare, lambda x: _residual(x, r)), *ACCENTS)

        return _let(regions(w), from_regions)

    return _let(word, steps)


def stem(tokens: Column) -> Column:
    """The stems of an array of lower-case words (see :func:`stem_word`)."""
    return F.transform(tokens, stem_word)


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of n tokens, joined by a space."""
    count = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    out = F.slice(tokens, F.lit(1), count)
    for k in range(1, n):
        out = F.zip_with(out, F.slice(tokens, F.lit(k + 1), count), lambda a, b: F.concat_ws(" ", a, b))
    return out


def parse_price(s: Column) -> Column:
    """Removes currency marks and reads the number; unreadable text gives null."""
    return F.trim(F.regexp_replace(s, "[£Â]", "")).try_cast("double")


def normalise_answer(s: Column) -> Column:
    """Synonyms of yes and no become ``si`` and ``no``; other answers stay, lower case and trimmed."""
    t = F.trim(F.lower(s))
    return F.when(t.isin(fv.YES_WORDS), F.lit("si")).when(t.isin(fv.NO_WORDS), F.lit("no")).otherwise(t)


def match_option(key: Column, options: Sequence[str]) -> Column:
    """The option an answer means: the same word, or for options of five letters or more one that
    contains the answer or is contained in it, in the order given; else null."""
    out = F.when(key.isin(list(options)), key)
    for option in options:
        if len(option) > 4:
            out = out.when(F.contains(F.lit(option), key) | F.contains(key, F.lit(option)), F.lit(option))
    return out


def is_help(s: Column) -> Column:
    return F.trim(F.lower(s)).isin(fv.HELP_WORDS)


def is_cancel(s: Column) -> Column:
    return F.lower(s).rlike("|".join(fv.CANCEL_WORDS))


def rule_code(field: Column, kind: str) -> Column:
    return F.concat(F.lit("UMBRAL_ALTO_" if kind == "max" else "UMBRAL_BAJO_"), F.upper(field))


def format_id(prefix: str, n: Column, width: int) -> Column:
    """Prefix and zero-padded number; longer numbers are kept whole."""
    return F.format_string(f"{prefix}%0{width}d", n)
