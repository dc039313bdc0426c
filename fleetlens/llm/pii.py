"""Personal data by weak supervision.

*Candidates* are the base matches (email, ip, card, phone: strict patterns with
their checks) and weaker ones: spelled-out emails, phones without a country
code, US social security numbers, IBANs, and titled names. Weak candidates that
overlap a base span are left out.

*Labelers* vote yes, no or abstain on every candidate: the pattern itself, a
validity rule, a gazetteer (top-level domains, calling codes, issuers, IBAN
countries, given names; reserved address ranges vote no), words before it that
announce such data, words that announce something else, and its boundaries.

*Aggregation*: expectation-maximisation over the counts of the vote patterns
(at most kinds x 3^6 x 2 rows, whatever the corpus) estimates how reliable each
labeler is and how likely each pattern is personal data.

*Classifier*: logistic regression on the votes, kind and length, fitted to
those probabilities over the same pattern counts. Weak candidates that it
accepts are added; base spans stay whatever it says.

Only DataFrame expressions run on the data; the two fits are a few lines of
arithmetic on the pattern counts. Positions are code points, end exclusive: the
text between matches and the matches themselves are measured and summed.

Defined results: a null text is empty and has no spans; repeated rows are
separate rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import load, staged

#: Kinds in the order of the results; the first four have base spans.
KINDS = ("email", "ip", "card", "phone", "iban", "name", "ssn")
N_BASE = 4
LABELERS = ("pattern", "valid", "gazetteer", "context", "counter", "boundary")
EM_ROUNDS, FIT_ROUNDS = 30, 400

_OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Possessive, and tried only where a match can start, so that runs of any
#: length cost linear time; the matches are those of the plain patterns.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WEAK = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]{2,24}){1,4}",
    "phone": r"(?<![0-9+.(-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.? [A-Z][a-z]{1,20}(?: [A-Z][a-z]{1,20})?",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A cheap sign that a text can hold a base match at all.
SIGN = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: Gazetteers.
TLDS = "com|org|net|edu|gov|info|io|co|de|fr|es|it|nl|uk|eu|ch|at|be|pl|se|ru|jp|cn|in|br|mx|us|ca|au"
CALLING = r"\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
ISSUERS = r"(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
RESERVED = r"(?:0|10|127|169\.254|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|255)\."
IBAN_COUNTRIES = "AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|GR|HU|IE|IT|LU|NL|NO|PL|PT|RO|SE|SK"
GIVEN = "James|John|Robert|Michael|William|David|Mary|Anna|Maria|Emma|Hans|Peter|Karl|Sophie|Marie|Jean|Pierre|Jose|Carlos|Luis|Juan|Elena"
#: Words before a candidate.
CONTEXT = {"email": "mail|contact|write|reach|kontakt|correo|courriel", "ip": r"\bip\b|host|server|address|login|adresse",
           "card": "card|visa|master|credit|pay|karte|carte|tarjeta", "phone": "phone|tel|call|mobile|fax|whatsapp|sms|nummer",
           "iban": "iban|account|bank|konto|compte|cuenta", "name": "name|dear|from|regards|signed|nom", "ssn": "ssn|social|security"}
COUNTER = r"version|order|invoice|isbn|build|ticket|serial|model|sku"


#: Elements of an array that one step of a scan goes through: a scan copies what it has
#: found once per chunk, not once per element.
CHUNK = 64
_SPAN = "array<struct<s:int,e:int,m:string,before:string,around:string>>"


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scan(items: Column, start: Column, step, kind: str) -> Column:
    """Outputs of ``step(state, item) -> (state, output)`` over an array, in order and in
    time in proportion to its length, chunk by chunk."""
    none = F.array().cast(kind)

    def one(acc, x):
        return _bound(F.struct(*[c.alias(n) for n, c in zip(("state", "out"), step(acc["state"], x))]), lambda r: F.struct(
            r["state"].alias("state"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

    def chunk(acc, part):
        inner = F.aggregate(part, F.struct(acc["state"].alias("state"), none.alias("out")), one)
        return _bound(inner, lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], r["out"]).alias("out")))

    def whole(every):
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(every) - 1) / CHUNK).cast("int")),
                            lambda i: F.slice(every, i * CHUNK + 1, F.lit(CHUNK)))
        return F.aggregate(parts, F.struct(start.alias("state"), none.alias("out")), chunk)["out"]
    return _bound(items, lambda every: F.when(F.size(every) > 0, whole(every)).otherwise(none))


def _last(text: Column, n: int) -> Column:
    return F.right(text, F.lit(n))


def _spans(text: Column, pattern: str, sign: str | None) -> Column:
    """All leftmost non-overlapping matches, with the 40 characters before each (lowered)
    and the two around it. The texts between matches give the places, so a text
    of many matches is gone through once."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if sign:
        found = F.when(F.contains(text, F.lit(sign)), found)
    none = F.array().cast(_SPAN)

    def pairs(found, gaps):
        following = F.zip_with(F.slice(gaps, 2, F.size(gaps)), F.slice(found, 2, F.size(found)), lambda g, m: F.when(
            g != "", F.left(g, F.lit(1))).otherwise(F.left(F.coalesce(m, F.lit("")), F.lit(1))))
        own = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), m.alias("m")))
        return F.filter(F.zip_with(own, following, lambda p, n: F.struct(
            p["gap"].alias("gap"), p["m"].alias("m"), F.coalesce(n, F.lit("")).alias("next"))), lambda p: p["m"].isNotNull())

    def step(state, x):
        s = state["at"] + F.length(x["gap"])
        e = s + F.length(x["m"])
        before = _last(F.concat(state["tail"], x["gap"]), 40)
        out = F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m"), F.lower(before).alias("before"),
                       F.concat(_last(before, 1), x["next"]).alias("around"))
        return F.struct(e.alias("at"), _last(F.concat(before, x["m"]), 40).alias("tail")), out

    def place(found):
        items = _bound(F.split(text, pattern, -1), lambda gaps: pairs(found, gaps))
        return _scan(items, F.struct(F.lit(0).alias("at"), F.lit("").alias("tail")), step, _SPAN)
    return _bound(found, lambda f: F.when(F.coalesce(F.size(f), F.lit(0)) > 0, place(f)).otherwise(none))


def _apart(weak: Column, taken: Column) -> Column:
    """The ``weak`` spans that touch none of the ``taken`` ones: both are laid on one line
    and gone through from the left (the largest end so far) and from the right (the
    nearest start)."""
    def line(w, t):
        ends = [F.transform(t, lambda x: F.struct(x["s"].alias("s"), F.lit(0).alias("w"), x["e"].alias("e"), F.lit(-1).alias("i"))),
                F.transform(w, lambda x, i: F.struct(x["s"].alias("s"), F.lit(1).alias("w"), x["e"].alias("e"), i.cast("int").alias("i")))]
        return F.sort_array(F.concat(*ends))

    def left(end, x):
        return F.when(x["w"] == 0, F.greatest(end, x["e"])).otherwise(end), F.when((x["w"] == 1) & (end > x["s"]), x["i"])

    def right(start, x):
        return F.when(x["w"] == 0, x["s"]).otherwise(start), F.when((x["w"] == 1) & (start < x["e"]), x["i"])

    def kept(w, t):
        every = line(w, t)
        hit = F.concat(_scan(every, F.lit(0), left, "array<int>"), _scan(F.reverse(every), F.lit(2 ** 31 - 1), right, "array<int>"))
        places = F.array_except(F.sequence(F.lit(0), F.size(w) - 1), F.array_compact(hit))
        return F.transform(places, lambda i: F.get(w, i))
    return F.when((F.size(weak) > 0) & (F.size(taken) > 0), kept(weak, taken)).otherwise(weak)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _check(kind: str):
    """The check of a base match; a failing match is dropped."""
    return {"email": lambda x: F.lit(True),
            "ip": lambda x: x["m"].rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
            "card": lambda x: F.call_function("luhn_check", _digits(x["m"])),
            "phone": lambda x: F.length(_digits(x["m"])).between(8, 15)}[kind]


def _vote(yes: Column | None, no: Column | None = None) -> Column:
    out = F.lit("-")
    if no is not None:
        out = F.when(no, "0").otherwise(out)
    return F.when(yes, "1").otherwise(out) if yes is not None else out


def _votes(kind: str, base: bool, x: Column) -> Column:
    """One character per labeler, and one for the length."""
    m, digits = x["m"], _digits(x["m"])
    valid = {
        "email": m.rlike(r"^[^@]{1,64}@.*\.[A-Za-z]{2,24}$") if base else None,
        "ip": ~m.rlike(r"(?:^|\.)0"), "card": m.rlike("^[3-6]"),
        "phone": F.length(digits).between(10, 13) if base else digits.rlike("^[2-9]"),
        "iban": F.length(F.replace(m, F.lit(" "))).between(15, 34), "name": None,
        "ssn": ~m.rlike("^(?:000|666|9)")}[kind]
    gazetteer = {
        "email": _vote(F.lower(m).rlike(rf"\.(?:{TLDS})$")), "ip": _vote(None, m.rlike(f"^{RESERVED}")),
        "card": _vote(m.rlike(f"^{ISSUERS}")),
        "phone": _vote(m.rlike(f"^{CALLING}"), ~m.rlike(f"^{CALLING}")) if base else _vote(None),
        "iban": _vote(m.rlike(f"^(?:{IBAN_COUNTRIES})"), ~m.rlike(f"^(?:{IBAN_COUNTRIES})")),
        "name": _vote(m.rlike(f" (?:{GIVEN})\\b")), "ssn": _vote(None)}[kind]
    before, around = x["before"], x["around"]
    return F.concat(
        _vote(F.lit(True)) if base else _vote(None),
        _vote(valid, ~valid) if valid is not None else _vote(None),
        gazetteer,
        _vote(before.rlike(CONTEXT[kind])),
        _vote(None, before.rlike(COUNTER)),
        _vote(~around.rlike("[A-Za-z0-9]"), around.rlike("[A-Za-z0-9]")),
        F.when(F.length(m) >= 20, "1").otherwise("0"))


def _free(weak: Column) -> Column:
    return _bound(F.col("taken"), lambda taken: _apart(weak, taken))


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``found``: structs ``k`` (kind), ``s``, ``e``, ``base``, ``votes``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    for kind, pattern in BASE.items():
        rows = rows.withColumn(f"base_{kind}", F.filter(_spans(F.col("text"), pattern, SIGN[kind]), _check(kind)))
    taken = F.concat(*[F.transform(f"base_{k}", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))) for k in BASE])
    rows = rows.withColumn("taken", taken)
    for kind, pattern in WEAK.items():
        rows = rows.withColumn(f"weak_{kind}", _bound(_spans(F.col("text"), pattern, None), _free))

    def judged(kind, base):
        return F.transform(f"{'base' if base else 'weak'}_{kind}", lambda x: F.struct(
            F.lit(KINDS.index(kind)).alias("k"), x["s"].alias("s"), x["e"].alias("e"), F.lit(base).alias("base"),
            _votes(kind, base, x).alias("votes")))
    every = F.concat(*[judged(k, True) for k in BASE], *[judged(k, False) for k in WEAK])
    return rows.select("doc_id", every.alias("found"))


def estimate(patterns: list[tuple[int, str, int]]) -> list[float]:
    """Probability that each ``(kind, votes, count)`` pattern is personal data."""
    p = [sum(v == "1" for v in votes[:6]) + 1 for _, votes, _ in patterns]
    n = [sum(v == "0" for v in votes[:6]) + 1 for _, votes, _ in patterns]
    post = [a / (a + b) for a, b in zip(p, n)]  # at first, the share of yes votes
    for _ in range(EM_ROUNDS):
        prior = {}
        for k in range(len(KINDS)):
            mine = [(q, c) for q, (kind, _, c) in zip(post, patterns) if kind == k]
            prior[k] = (1 + sum(q * c for q, c in mine)) / (2 + sum(c for _, c in mine))
        yes = []  # per labeler: chance of a yes vote, given it votes, on personal data and on others
        for j in range(len(LABELERS)):
            given = [(q, c, votes[j] == "1") for q, (_, votes, c) in zip(post, patterns) if votes[j] != "-"]
            yes.append(((2 + sum(q * c for q, c, v in given if v)) / (3 + sum(q * c for q, c, _ in given)),
                        (1 + sum((1 - q) * c for q, c, v in given if v)) / (3 + sum((1 - q) * c for q, c, _ in given))))
        post = []
        for kind, votes, _ in patterns:
            odds = math.log(prior[kind] / (1 - prior[kind]))
            for (a, b), v in zip(yes, votes):
                if v != "-":
                    odds += math.log(a / b) if v == "1" else math.log((1 - a) / (1 - b))
            post.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return post


def _inputs(kind: int, votes: str) -> list[float]:
    return ([float(k == kind) for k in range(len(KINDS))] + [float(v == "1") for v in votes[:6]]
            + [float(v == "0") for v in votes[:6]] + [float(votes[6] == "1")])


def fit_classifier(patterns: list[tuple[int, str, int]], post: list[float]) -> list[float]:
    """Weights of the logistic classifier, by gradient steps on the pattern counts."""
    total = sum(c for _, _, c in patterns) or 1
    x = [_inputs(k, v) for k, v, _ in patterns]
    w = [0.0] * (len(KINDS) + 13)
    for _ in range(FIT_ROUNDS):
        grad = [0.001 * v for v in w]
        for xi, q, (_, _, c) in zip(x, post, patterns):
            err = (1 / (1 + math.exp(-sum(a * b for a, b in zip(w, xi)))) - q) * c / total
            for i, v in enumerate(xi):
                if v:
                    grad[i] += err
        w = [a - 2.0 * g for a, g in zip(w, grad)]
    return w


def _score(x: Column, w: list[float]) -> Column:
    out = F.element_at(F.array(*map(F.lit, w[: len(KINDS)])), x["k"] + 1)
    for j in range(len(LABELERS)):
        v = F.substring(x["votes"], j + 1, 1)
        out = out + F.when(v == "1", w[len(KINDS) + j]).when(v == "0", w[len(KINDS) + 6 + j]).otherwise(0.0)
    return out + F.when(F.substring(x["votes"], 7, 1) == "1", w[-1]).otherwise(0.0)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, found``: base spans and the weak ones that the classifier accepts."""
    every = staged(candidates(docs), "pii-candidates")
    counts = (every.select(F.explode("found").alias("x")).groupBy("x.k", "x.votes").agg(F.count("*").alias("n"))
              .orderBy("k", "votes").collect())
    patterns = [(r["k"], r["votes"], r["n"]) for r in counts]
    w = fit_classifier(patterns, estimate(patterns))
    kept = F.filter("found", lambda x: x["base"] | (_score(x, w) > 0))
    return every.select("doc_id", kept.alias("found"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(load(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, KINDS))

    def listed(spans):
        order = F.sort_array(F.transform(spans, lambda x: F.struct(x["k"], x["s"], x["e"])))
        return F.array_join(F.transform(order, lambda x: F.concat_ws(
            ":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")
    base = F.filter("found", lambda x: x["base"])

    def count(i):
        return F.size(F.filter("found", lambda x: x["base"] & (x["k"] == i))).cast("long").alias(f"n_{KINDS[i]}")
    return found.select("doc_id", *map(count, range(N_BASE)), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
                        listed(F.col("found")).alias("spans"))
