"""Personal data by weak supervision, in DataFrame functions only.

Candidates are the base matches of four kinds and looser ones: national phone numbers, e-mail addresses written
with "at" and "dot", card-like numbers whose check digit fails (typing errors, account numbers), national
identity numbers, names, street addresses and dates of birth. Labelers vote on every candidate (+1 personal, -1 not, 0 no
opinion) and disagree: a format check, gazetteers, words before it, the characters around it, its shape,
and whether base matches stand near it. Expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is for each kind. Its posteriors train a logistic span classifier on
the votes and on features that no labeler sees (length, what precedes, capitals), which decides on the
looser candidates. Base matches stay whatever it says.

The counts of (votes, features) patterns cover all candidates of all documents. A kind has at most 3 ** 6 * 24 patterns
whatever the number of documents, so the fit itself is arithmetic on a table of bounded size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .spans import apart, masked, spans
from .storage import written

#: The base kinds, then those that only the method finds.
KINDS = ("email", "ip", "card", "phone", "national_id", "name", "address", "birth_date")
BASE_KINDS = 4
#: Rounds of expectation-maximisation and of the classifier's fit; probability from which a loose candidate is a span.
ROUNDS, STEPS, SURE = 40, 200, 0.9
#: Characters on either side of a candidate that labelers see; characters within which a base match is near.
CONTEXT, NEAR = 24, 200

# Fixed values. Possessive forms match what the plain ones do, in time linear in the text.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
LOOSE_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+ ?[\[(] ?[aA][tT] ?[\])] ?[A-Za-z0-9-]{1,63}+(?: ?(?:[\[(] ?[dD][oO][tT] ?[\])]|\.) ?[A-Za-z0-9-]{1,63}+){1,4}+"
LOOSE_PHONE = r"(?<![0-9A-Za-z+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])"
NATIONAL_ID = r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
NAME = r"(?<![A-Za-z0-9])(?:(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur)\.? )?[A-Z][a-z]{1,14} [A-Z][a-z]{1,19}(?![A-Za-z0-9])"
ADDRESS = r"(?<![A-Za-z0-9.-])[0-9]{1,5} (?:[A-Z][a-z]{1,19} ){1,3}(?:Street|St|Avenue|Ave|Road|Rd|Lane|Drive|Boulevard|Blvd|Court|Square|Way)(?![A-Za-z0-9])"
DATE = r"(?<![0-9A-Za-z./-])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{1,2} (?:January|February|March|April|May|June|July|August|September|October|November|December) (?:19|20)[0-9]{2})(?![0-9A-Za-z-])"
DOMAINS = r"(?i)(?:\.|dot[\])] ?)(?:com|org|net|edu|gov|io|de|fr|es|uk|eu|info|biz|co|us|ca|ch|at)$"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|30|36|38|6011|65|35|62)"
RESERVED = r"^(?:0|127|255|22[4-9]|2[3-5][0-9])\."
FIRST_NAMES = "Ahmed|Alice|Ana|Andrew|Anna|Anthony|Barbara|Carlos|Charles|Christopher|Daniel|David|Elena|Elizabeth|Emily|Emma|Fatima|George|Hans|Hannah|Helen|Jack|James|Jan|Jennifer|Jean|John|Jose|Joseph|Juan|Julia|Karen|Laura|Linda|Lisa|Luis|Margaret|Maria|Marie|Mark|Mary|Matthew|Michael|Mohammed|Nancy|Patricia|Paul|Peter|Pierre|Richard|Robert|Sarah|Sofia|Susan|Thomas|Wei|William"
NO_NAMES = "The|This|That|These|Those|In|On|At|Of|And|But|For|From|With|New|North|South|East|West|United|General|Public|Apache|Creative|License|Version|Street|Road|January|February|March|April|May|June|July|August|September|October|November|December|Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday"
BEFORE = {
    0: r"(?i)(?:mail|contact|reach|write|address|to)\b[^A-Za-z0-9]*$",
    1: r"(?i)(?:address|host|server|login|ip|from|client)\b[^A-Za-z0-9]*$",
    2: r"(?i)(?:card|visa|mastercard|amex|credit|debit|account|iban|pan|payment)\b(?: (?:number|no\.?))?[^A-Za-z0-9]*$",
    3: r"(?i)(?:phone|tel|call|mobile|cell|fax|contact|reach|dial)\b[^A-Za-z0-9]*$",
    4: r"(?i)(?:ssn|social security|security|identity|id|tax)\b(?: (?:number|no\.?))?[^A-Za-z0-9]*$",
    5: r"(?i)(?:name|dear|by|signed|from|contact|regards|patient|customer|employee|mr|mrs|ms|dr)\b[^A-Za-z0-9]*$",
    6: r"(?i)(?:at|address|lives|resides|deliver|ship|home|to)\b[^A-Za-z0-9]*$",
    7: r"(?i)(?:born|birth|dob|birthday|nacid[oa]|geboren|née?)\b(?: (?:on|am|el|le))?[^A-Za-z0-9]*$",
}
AGAINST = r"(?i)(?:version|isbn|issn|order|invoice|ticket|build|section|page|release|part|serial|sku|item|tracking|updated|published|issue|no\.?|#|\bv)[ :#]*(?:number[ :#]*|on )?$"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _count(s: Column) -> Column:
    return F.length(_digits(s))


def _luhn(s: Column) -> Column:
    return F.call_function("luhn_check", _digits(s))


def _has(s: Column, regex: str) -> Column:
    return F.rlike(s, F.lit(regex))


def base_spans(text: Column, around: int = 0) -> Column:
    """The base matches of the four base kinds: array<struct<start,kind,end,value>>, see ``spans``."""
    card = lambda v: F.when(_count(v).between(14, 19), _luhn(v)).otherwise(False)
    small = lambda v: F.forall(F.split(v, r"\."), lambda p: _has(p, "^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    return F.concat(
        spans(text, EMAIL, 0, lambda v: F.lit(True), F.contains(text, F.lit("@")), around),
        spans(text, IP, 1, small, _has(text, r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), around),
        spans(text, CARD, 2, card, _has(text, r"[0-9](?:[ -]?[0-9]){13}"), around),
        spans(text, PHONE, 3, lambda v: _count(v).between(10, 15), _has(text, r"\+[0-9]"), around),
    )


def loose_spans(text: Column, base: Column) -> Column:
    """Candidates beside the base matches, with their context."""
    every = lambda v: F.lit(True)
    card_like = lambda v: F.when(_count(v).between(13, 19), ~_luhn(v) | (_count(v) == 13)).otherwise(False)
    found = F.concat(
        spans(text, LOOSE_EMAIL, 0, every, _has(text, r"[\[(] ?[aA][tT] ?[\])]"), CONTEXT),
        spans(text, CARD, 2, card_like, _has(text, r"[0-9](?:[ -]?[0-9]){12}"), CONTEXT),
        spans(text, LOOSE_PHONE, 3, every, _has(text, r"[0-9]{3}[ .-][0-9]{4}"), CONTEXT),
        spans(text, NATIONAL_ID, 4, every, _has(text, r"[0-9]{3}-[0-9]{2}-[0-9]{4}"), CONTEXT),
        spans(text, NAME, 5, lambda v: _has(v, rf"\b(?:{FIRST_NAMES})\b|^(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur)\b"), _has(text, r"[a-z] [A-Z][a-z]"), CONTEXT),
        spans(text, ADDRESS, 6, every, _has(text, r"[0-9] [A-Z][a-z]"), CONTEXT),
        spans(text, DATE, 7, every, _has(text, r"(?:19|20)[0-9]{2}"), CONTEXT),
    )
    return apart(found, base)


LABELERS = ("check", "gazetteer", "before", "around", "shape", "company")
FEATURES = ("length", "lead", "capital")


def _voted(found: Column, base: Column, is_base: bool) -> Column:
    """The spans with the labelers' votes and the features."""

    def votes(s: Column) -> Column:
        value, kind = s["value"], s["kind"]
        digits = _digits(value)
        vote = lambda good, bad: F.when(good, 1).when(bad, -1).otherwise(0)
        never = F.lit(False)
        ident = ~_has(digits, "^(?:000|666|9)|^...00|0000$")
        check = F.lit(1) if is_base else F.when(kind == 2, -1).when(kind == 4, vote(ident, ~ident)).otherwise(0)
        gazetteer = (
            F.when(kind == 0, vote(_has(value, DOMAINS), never))
            .when(kind == 1, vote(never, _has(value, RESERVED)))
            .when(kind == 2, vote(_has(digits, ISSUERS), _has(digits, "^(?:19|20)[0-9]{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])")))
            .when(kind == 3, vote(_has(digits, "^1?[2-9]"), _has(digits, "^1?0")))
            .when(kind == 5, vote(_has(value, rf"\b(?:{FIRST_NAMES})\b"), _has(value, rf"\b(?:{NO_NAMES})\b")))
            .when(kind == 6, vote(_has(value, "(?:Street|Avenue|Road|Lane|Boulevard)$"), never))
            .when(kind == 7, vote(_has(value, "19[3-9][0-9]"), _has(value, "20[2-9][0-9]")))
            .otherwise(0)
        )
        shape = (
            F.when(kind == 0, vote(F.length(value) <= 64, F.length(value) > 128))
            .when(kind == 2, vote(_has(value, "^(?:[0-9]{15,16}|[0-9]{4}(?:[ -][0-9]{4}){3})$"), _has(value, r"[ -][0-9]{1,2}[ -]|[0-9]{17}")))
            .when(kind == 5, vote(_has(value, r"^(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur)\b"), never))
            .when(kind.isin(6, 7), F.lit(0))
            .otherwise(vote(_has(value, r"[ ().-]"), _has(digits, r"^(.)\1+$")))
        )
        edge = F.right(s["before"], F.lit(1))
        around = vote(_has(s["after"], r"^(?:$|[\s,;.)!?\"'*%$&#|])") & _has(edge, r"^(?:$|[\s(\"':,;|])"), _has(s["after"], r"^[A-Za-z0-9=/_\\:-]") | _has(edge, r"[A-Za-z0-9=/_\\#-]"))
        good = F.lit(False)
        for k, regex in BEFORE.items():
            good = good | ((kind == k) & _has(s["before"], regex))
        context = vote(good, _has(s["before"], AGAINST))
        near = F.exists(base, lambda b: (b["start"] < s["end"] + NEAR) & (s["start"] < b["end"] + NEAR) & (b["start"] != s["start"]))
        length = F.when(F.length(value) < 12, 0).when(F.length(value) < 20, 1).otherwise(2)
        lead = F.when(_has(s["before"], r"[:=]\s*$"), 1).when(_has(s["before"], r"(?:^|\n)\s*$"), 2).when(_has(s["before"], r"[A-Za-z]\s*$"), 3).otherwise(0)
        named = zip(LABELERS + FEATURES, (check, gazetteer, context, around, shape, F.when(near, 1).otherwise(0), length, lead, F.when(_has(value, "[A-Z]"), 1).otherwise(0)), strict=True)
        return F.struct(s["start"].alias("start"), kind.alias("kind"), s["end"].alias("end"), *(c.alias(n) for n, c in named))

    return F.transform(found, votes)


def reliabilities(counts: dict[tuple[int, ...], int]) -> dict[tuple[int, ...], float]:
    """Posterior of "personal" for each pattern (kind, votes ...), by expectation-maximisation over the counts;
    each kind has its own prior and each labeler its own table of votes for it."""
    post = {p: min(0.95, max(0.05, 0.5 + 0.15 * sum(p[1:]))) for p in counts}
    for _ in range(ROUNDS):
        table: dict[tuple, float] = {}
        for p, n in counts.items():
            for y, w in ((1, post[p] * n), (0, (1 - post[p]) * n)):
                table[p[0], y] = table.get((p[0], y), 2.0) + w
                for i, v in enumerate(p[1:]):
                    table[p[0], y, i, v] = table.get((p[0], y, i, v), 1.0 + (v == 2 * y - 1)) + w
        for p in counts:
            logit = math.log(table[p[0], 1] / table[p[0], 0])
            for i, v in enumerate(p[1:]):
                logit += math.log(table[p[0], 1, i, v] / (table[p[0], 1] + 2)) - math.log(table[p[0], 0, i, v] / (table[p[0], 0] + 2))
            post[p] = 1 / (1 + math.exp(-min(30.0, max(-30.0, logit))))
    return post


#: Values of a vote and of each feature.
_VALUES = dict.fromkeys(LABELERS, (-1, 0, 1)) | {"length": (0, 1, 2), "lead": (0, 1, 2, 3), "capital": (0, 1)}


def span_classifier(counts: dict[tuple[int, ...], int], post: dict[tuple[int, ...], float]) -> dict[tuple, float]:
    """Weights (kind,) and (kind, name, value) of a logistic classifier, fitted by gradient steps on the posteriors of patterns
    (kind, votes ..., features ...)."""
    weights: dict[tuple, float] = {}
    total: dict[int, int] = {}
    used = {p: [(p[0],), *((p[0], name, v) for name, v in zip(LABELERS + FEATURES, p[1:], strict=True))] for p in counts}
    for p, n in counts.items():
        total[p[0]] = total.get(p[0], 0) + n
        weights.update(dict.fromkeys(used[p], 0.0))
    for _ in range(STEPS):
        slope = {k: 0.001 * w for k, w in weights.items()}
        for p, n in counts.items():
            z = sum(weights[k] for k in used[p])
            gap = (1 / (1 + math.exp(-min(30.0, max(-30.0, z)))) - post[p[: 1 + len(LABELERS)]]) * n / total[p[0]]
            for k in used[p]:
                slope[k] += gap
        for k in weights:
            weights[k] -= 2.0 * slope[k]
    return weights


def find_personal_data(docs: DataFrame, sure: float = SURE) -> DataFrame:
    """``doc_id, base, spans`` for each row of ``docs`` (doc_id, text): arrays of struct<start,kind,end> (code points,
    end exclusive; kind is a place in KINDS), all base matches and, in ``spans``, also the candidates that
    the classifier takes for personal data; these overlap no base match and, of a place with several, the first kind stays.

    Null counts as the empty text, which has no spans. Repeated rows repeat. Other columns are ignored. Without
    candidates there is nothing to fit and nothing to add.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", text.alias("text")).withColumn("hits", base_spans(F.col("text"), CONTEXT))
    found = found.withColumn("loose", loose_spans(F.col("text"), F.col("hits")))
    voted = written(found.select("doc_id", _voted(F.col("hits"), F.col("hits"), True).alias("base"), _voted(F.col("loose"), F.col("hits"), False).alias("loose")), "pii-votes")
    every = voted.select(F.explode(F.concat("base", "loose")).alias("s")).groupBy("s.kind", *(f"s.{x}" for x in LABELERS + FEATURES)).count()
    patterns = {tuple(r)[:-1]: r["count"] for r in every.collect()}  # bounded by the number of patterns
    counts: dict[tuple[int, ...], int] = {}
    for p, n in patterns.items():
        counts[p[: 1 + len(LABELERS)]] = counts.get(p[: 1 + len(LABELERS)], 0) + n
    weights = span_classifier(patterns, reliabilities(counts))
    plain = lambda found: F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    of_kinds = lambda values: F.array(*(F.lit(float(v)) for v in values))

    def taken(s: Column) -> Column:
        score = F.element_at(of_kinds(weights.get((k,), -30.0) for k in range(len(KINDS))), s["kind"] + 1)
        for name, values in _VALUES.items():
            table = of_kinds(weights.get((k, name, v), 0.0) for k in range(len(KINDS)) for v in values)
            score = score + F.element_at(table, s["kind"] * len(values) + s[name] - values[0] + 1)
        return score >= math.log(sure / (1 - sure))

    added = plain(F.filter("loose", taken))
    alone = F.filter(added, lambda s: ~F.exists(added, lambda b: (b["kind"] < s["kind"]) & (s["start"] < b["end"]) & (b["start"] < s["end"])))
    return voted.select("doc_id", plain(F.col("base")).alias("base"), F.concat(plain(F.col("base")), alone).alias("spans"))


def mask_personal_data(docs: DataFrame, mask: str = "[private]") -> DataFrame:
    """``doc_id, text`` with every span replaced. Rows are matched by doc_id, which must be unique here."""
    return docs.select("doc_id", "text").join(find_personal_data(docs), "doc_id").select("doc_id", masked(F.col("text"), F.col("spans"), mask).alias("text"))
