"""Secret scan by patterns and by sliding-window Shannon entropy, in DataFrame functions only.

Beside three base patterns, long strings of token characters are candidates. Harmless parts of a candidate
(words between separators, which make up paths and identifiers, UUIDs, segments with a placeholder) are blanked, only
they and not the whole candidate. For each character class a window slides over the rest; the counts of its
characters are kept up to date by one character in and one out, and the entropy follows from the running sum of
count * log2(count). A candidate is a secret if some window without a blank reaches a class's threshold.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .spans import masked, spans, uncovered

KINDS = ("assign", "access", "hex", "entropy")
# Fixed values.
ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
#: Shortest candidate.
LEAST = 20
_END = r"(?![A-Za-z0-9])"
#: Harmless parts of a candidate. A segment is a run of letters and digits; longer ones than 19 are no words here, the
#: classes judge them.
HARMLESS = (
    rf"(?<![A-Za-z0-9])[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}{_END}",
    r"(?<![A-Za-z0-9])[A-Za-z0-9]*?(?i:example|sample|dummy|placeholder|changeme|x{6}|0{8}|abcdefgh|12345678|lorem|redacted)[A-Za-z0-9]*",
    rf"(?<![A-Za-z0-9])(?=[A-Za-z0-9]{{3,{LEAST - 1}}}{_END})(?:[A-Z]?[a-z]{{2,}}+(?:[A-Z][a-z]+){{0,8}}|[A-Z]{{4,}})[0-9]{{0,4}}{_END}",
)
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Class name: (its characters, window, least entropy in bits, what the string must show, whether the string is the
#: candidate between blanks, with its separators, or one segment). By simulation 1 of 100 random strings of 20
#: characters stays below the thresholds of the classes of segments. Letters of words reach them too, so they must show what
#: words seldom do: a lone small letter between capitals, six consonants in a row, or an entropy above words'.
CLASSES = {
    "hex": ("0123456789abcdef", 24, 3.1, r"^(?=.*[0-9])(?=.*[a-fA-F])[0-9a-fA-F]+$", False),
    "alphanumeric": (_LETTERS + "0123456789+/_=-", 20, 3.7, r"^(?=(?:.*[0-9]){2})(?=.*[a-z])(?=.*[A-Z])", True),
    "lower and digits": ("abcdefghijklmnopqrstuvwxyz0123456789", 20, 3.4, r"^(?=(?:.*[0-9]){2})(?=.*[0-9][a-z])[a-z0-9]+$", False),
    "upper and digits": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 20, 3.3, r"^(?=.*[0-9][A-Z])[A-Z0-9]+$", False),
    "mixed letters": (_LETTERS + "0123456789", 20, 3.6, r"[A-Z][a-z][A-Z]", False),
    "diverse letters": (_LETTERS, 20, 4.1, r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z]+$", False),
    "letters of one case": ("abcdefghijklmnopqrstuvwxyz", 20, 3.4, r"^(?:(?=.*[b-df-hj-np-tv-xz]{6})[a-z]+|(?=.*[B-DF-HJ-NP-TV-XZ]{6})[A-Z]+)$", False),
}


def peak_entropy(value: Column, alphabet: str, window: int) -> Column:
    """The largest Shannon entropy, in bits, of the ``window``-character windows of ``value``: 0.0 if it is shorter.
    Characters outside the alphabet share one count."""
    places = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(alphabet), c))
    logs = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 1)))
    log_of = lambda count: F.element_at(logs, count + 1)
    zero = F.struct(F.array_repeat(F.lit(0), len(alphabet) + 1).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))

    def step(place: Column, state: Column, i: Column) -> Column:
        into = F.element_at(place, i + 1)
        out = F.when(i >= window, F.element_at(place, F.greatest(i - window, F.lit(0)) + 1)).otherwise(F.lit(-1))
        had = F.element_at(state["counts"], into + 1)
        lost = F.when(out >= 0, F.element_at(state["counts"], F.greatest(out, F.lit(0)) + 1)).otherwise(F.lit(0))
        moved = (out == into) & (out >= 0)
        total = F.when(moved, state["sum"]).otherwise(state["sum"] + log_of(F.least(had + 1, F.lit(window))) - log_of(had) + F.when(out >= 0, log_of(F.greatest(lost - 1, F.lit(0))) - log_of(lost)).otherwise(F.lit(0.0)))
        counts = F.when(moved, state["counts"]).otherwise(F.transform(state["counts"], lambda c, k: c + F.when(k == into, 1).otherwise(0) - F.when(k == out, 1).otherwise(0)))
        bits = F.lit(math.log2(window)) - total / window
        best = F.when(i >= window - 1, F.greatest(state["best"], bits)).otherwise(state["best"])
        return F.struct(counts.alias("counts"), total.alias("sum"), best.alias("best"))

    # the places are a variable, so that no step makes them anew
    best = F.transform(F.array(places), lambda place: F.aggregate(F.sequence(F.lit(0), F.length(value) - 1), zero, lambda state, i: step(place, state, i), lambda s: s["best"]))
    return F.when(F.length(value) >= window, best[0]).otherwise(F.lit(0.0))


def base_spans(text: Column) -> Column:
    """Matches of the base patterns: array<struct<start,kind,end,value>>."""
    long_value = lambda v: F.length(F.regexp_extract(v, ASSIGN, 1)) >= 8
    return F.concat(
        spans(text, ASSIGN, 0, long_value, F.rlike(text, F.lit(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"))),
        spans(text, ACCESS, 1, lambda v: F.lit(True), F.contains(text, F.lit("AKIA"))),
        spans(text, HEX, 2, lambda v: F.lit(True), F.rlike(text, F.lit(HEX))),
    )


def high_entropy(value: Column) -> Column:
    """Whether a candidate string is a secret by the entropy of its windows outside harmless parts."""
    rest = value
    for pattern in HARMLESS:
        rest = F.regexp_replace(rest, pattern, " ")

    def secret(across: bool) -> Callable[[Column], Column]:
        def judge(string: Column) -> Column:
            found = F.length(string) < 0
            for alphabet, window, bits, shows, with_separators in CLASSES.values():
                if with_separators == across:
                    same = F.lower(string) if alphabet == alphabet.lower() else string
                    found = found | F.when(F.rlike(string, F.lit(shows)), peak_entropy(same, alphabet, window) >= bits).otherwise(F.lit(False))
            return (F.length(string) >= LEAST) & found

        return judge

    return F.exists(F.split(rest, " "), secret(True)) | F.exists(F.split(rest, "[^A-Za-z0-9]+"), secret(False))


def _hits(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    found = docs.withColumn("__base", base_spans(F.coalesce(text, F.lit(""))))
    loose = spans(F.coalesce(text, F.lit("")), TOKEN, 3, lambda v: F.lit(True), F.rlike(text, F.lit(r"[A-Za-z0-9+/_=-]{20}")))
    return found.withColumn("__loose", F.filter(uncovered(loose, F.col("__base"), LEAST), lambda s: high_entropy(s["value"])))


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans`` for each row of ``docs`` (doc_id, text): arrays of struct<start,kind,end,value> in code
    points, end exclusive; kind is a place in KINDS. ``base`` has the base matches, ``spans`` also the strings of high
    entropy outside them: of a candidate that overlaps base matches, its parts between them.

    Null counts as the empty text, which has no spans. Repeated rows repeat. Other columns are ignored.
    """
    return _hits(docs.select("doc_id", "text")).select("doc_id", F.col("__base").alias("base"), F.concat("__base", "__loose").alias("spans"))


def redact_secrets(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs``, all columns, with every secret in ``text`` replaced by ``mask``; other texts, null too, stay."""
    return _hits(docs).withColumn("text", masked(F.col("text"), F.concat("__base", "__loose"), mask)).select(*docs.columns)
