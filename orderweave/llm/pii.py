"""Personal data by weak supervision: labelers vote on candidate spans, and a classifier decides.

Candidates are the matches of patterns: e-mail, IP, card and phone (the base kinds), and IBANs, social security numbers
and names after a title (the added kinds). Five labelers vote on each: strict form, gazetteer, context words before it, free
borders, usual length. Expectation maximisation over the counts of all vote patterns of the corpus (at most 2**5 for each kind)
estimates how reliable each labeler is, and a logistic span classifier is trained on the posteriors.
Base spans that pass their test always stay; an added span stays if the classifier gives it one half or more and it
does not overlap a base span. Everything, training too, is built-in SQL functions; only the few weights reach the driver.

Patterns are the plain ones made linear: possessive repeats, and no start inside a run that has been tried from its
beginning. A match and its place are found by cutting the text at the matches.

Defined cases: a null or empty text has no spans (and no redacted text if null); offsets count code points, the end
is exclusive; rows that repeat a doc_id stand for themselves; an empty table gives no rows, and a corpus without candidates the
untrained classifier; helper columns start with two underscores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweave.session import materialize

LOCAL = "A-Za-z0-9._%+-"
#: Base kinds in their order, then the added kinds.
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "name": r"(?<!\p{L})(?:Mrs|Mr|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señora|Señor)\.?\x20\p{Lu}\p{L}+"
            r"(?:\x20\p{Lu}\p{L}+)?",
}
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "name")
#: A text without this cannot match the kind.
NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+[0-9]", "iban": "[A-Z]{2}[0-9]{2}",
         "ssn": "[0-9]{3}-[0-9]{2}-", "name": r"\b(?:Mrs|Mr|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señora|Señor)\b"}

#: What each kind's gazetteer knows: how a true one begins.
GAZETTEER = {
    "email": "^[A-Za-z]", "ip": r"^(?!0\.|10\.|127\.|169\.254\.|192\.168\.|22[4-9]\.|2[3-5][0-9]\.)",
    "card": "^(?:4|5[1-5]|2[2-7]|3[0-9]|6)", "phone": r"^\+(?:1|2[07]|3[0-9]|4[0-9]|5[0-9]|6[0-9]|7|8[1-9]|9[0-9])",
    "iban": "^(?:AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|GR|HU|IE|IT|LU|NL|NO|PL|PT|SE)", "ssn": "^(?!000|666|9)",
    "name": "^(?:Mrs|Mr|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señora|Señor)",
}
CONTEXT = (r"(?i)(?:mail|contact|write|phone|call|tel|fax|card|visa|account|iban|bank|ssn|social|security|name|from|"
           r"address|host|server|kontakt|konto|telefon|karte|courriel|compte|carte|correo|cuenta|tarjeta)")
CONTEXT_LENGTH = 40
USUAL_LENGTH = {"email": (6, 64), "ip": (7, 15), "card": (13, 23), "phone": (10, 20), "iban": (15, 42), "ssn": (11, 11),
                "name": (5, 60)}
LABELERS = ("form", "gazetteer", "context", "borders", "length")

EM_ROUNDS, FIT_ROUNDS, FIT_STEP, DECAY = 30, 400, 2.0, 1e-4
CANDIDATE = "array<struct<kind:string,start:int,end:int,base:boolean,votes:array<int>>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def passes(kind: str, match: Column) -> Column:
    """The test of a base kind, and the strict form of an added one."""
    digits = _digits(match)
    if kind == "ip":
        def small(part: Column) -> Column:
            number = F.regexp_replace(part, "^0+", "")
            return F.when(F.length(number) <= 3, F.concat(F.lit("0"), number).cast("int") <= 255).otherwise(F.lit(False))

        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        fits = F.length(digits).between(13, 19)
        return F.when(fits, _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _matches(text: Column, kind: str) -> Column:
    """(start, end, match) of all matches: the texts between them tell where they are."""
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string>>").alias("out"))

    def place(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["between"])
        end = begin + F.length(pair["match"])
        one = F.struct(begin.alias("start"), end.alias("end"), pair["match"].alias("match"))
        placed = F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))
        return F.when(pair["match"].isNull(), state).otherwise(placed)  # the text after the last match

    pairs = F.zip_with(found, between, lambda m, b: F.struct(m.alias("match"), b.alias("between")))
    return F.aggregate(pairs, start, place, lambda state: state["out"])


def _vote(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


def _candidates(text: Column, kind: str) -> Column:
    low, high = USUAL_LENGTH[kind]

    def judged(one: Column) -> Column:
        match, before = one["match"], F.greatest(one["start"] - CONTEXT_LENGTH, F.lit(0))
        ok = passes(kind, match)
        context = F.substring(text, before + 1, one["start"] - before)
        near = F.concat(F.substring(text, one["start"], F.when(one["start"] > 0, 1).otherwise(0)), F.lit(" "),
                        F.substring(text, one["end"] + 1, F.lit(1)))
        votes = F.array(
            _vote(ok), _vote(match.rlike(GAZETTEER[kind])), _vote(context.rlike(CONTEXT)),
            _vote(~near.rlike(r"[\p{L}\p{N}_]")), _vote(F.length(match).between(low, high)))
        return F.struct(
            F.lit(kind).alias("kind"), one["start"].alias("start"), one["end"].alias("end"),
            (F.lit(kind in BASE) & ok).alias("base"), votes.alias("votes"))

    return F.when(text.rlike(NEEDS[kind]), F.transform(_matches(text, kind), judged)).otherwise(
        F.array().cast(CANDIDATE))


def candidates(docs: DataFrame) -> DataFrame:
    """All columns and ``__candidates``: by kind, then by start."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn("__candidates", F.concat(*[_candidates(text, kind) for kind in PATTERNS]))


def _total(patterns: Column, value) -> Column:
    return F.aggregate(patterns, F.lit(0.0), lambda total, p: total + value(p))


def _slope(patterns: Column, j: int) -> Column:
    return _total(patterns, lambda p: p["by"] * p["votes"][j])


def _sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def fit(votes: DataFrame) -> list[float]:
    """Bias and labeler weights of the span classifier, from all vote patterns (votes, n) of the corpus."""
    patterns = votes.groupBy("votes").agg(F.sum("n").cast("double").alias("n"))
    row = patterns.agg(F.collect_list(F.struct("votes", "n")).alias("patterns"))
    width, everything = len(LABELERS), F.col("patterns")
    weight = F.greatest(_total(everything, lambda p: p["n"]), F.lit(1.0))

    def posterior(state: Column, p: Column) -> Column:
        odds = F.log(state["prior"] / (1 - state["prior"]))
        for j in range(width):
            hit, miss = state["hit"][j], state["miss"][j]
            odds = odds + F.when(p["votes"][j] == 1, F.log(hit / miss)).otherwise(F.log((1 - hit) / (1 - miss)))
        return _sigmoid(odds)

    def again(state: Column, _: Column) -> Column:
        believed = F.transform(everything, lambda p: F.struct(
            p["votes"].alias("votes"), p["n"].alias("n"), (p["n"] * posterior(state, p)).alias("yes")))
        yes = _total(believed, lambda p: p["yes"])

        def rate(j: int, part) -> Column:
            seen = _total(believed, lambda p: part(p))
            return (_total(believed, lambda p: part(p) * p["votes"][j]) + 1.0) / (seen + 2.0)

        return F.struct(
            ((yes + 1.0) / (weight + 2.0)).alias("prior"),
            F.array(*[rate(j, lambda p: p["yes"]) for j in range(width)]).alias("hit"),
            F.array(*[rate(j, lambda p: p["n"] - p["yes"]) for j in range(width)]).alias("miss"))

    start = F.struct(
        F.lit(0.5).alias("prior"), F.array(*[F.lit(0.8)] * width).alias("hit"),
        F.array(*[F.lit(0.3)] * width).alias("miss"))
    learned = F.aggregate(F.sequence(F.lit(1), F.lit(EM_ROUNDS)), start, again)
    believed = row.select("patterns", learned.alias("model")).select(F.transform("patterns", lambda p: F.struct(
        p["votes"].alias("votes"), p["n"].alias("n"), posterior(F.col("model"), p).alias("yes"))).alias("patterns"))
    believed = materialize(believed, "span-posteriors")

    def descend(w: Column, _: Column) -> Column:
        def linear(p: Column) -> Column:
            out = w[0]
            for j in range(width):
                out = out + w[j + 1] * p["votes"][j]
            return out

        missed = F.transform(everything, lambda p: F.struct(
            p["votes"].alias("votes"), (p["n"] / weight * (p["yes"] - _sigmoid(linear(p)))).alias("by")))
        slopes = [_total(missed, lambda p: p["by"])] + [
            _slope(missed, j) for j in range(width)]
        return F.array(*[w[k] + FIT_STEP * (slope - DECAY * w[k]) for k, slope in enumerate(slopes)])

    zero = F.array(*[F.lit(0.0)] * (width + 1))
    return list(believed.select(
        F.aggregate(F.sequence(F.lit(1), F.lit(FIT_ROUNDS)), zero, descend).alias("w")).first()["w"])


def find_spans(docs: DataFrame) -> DataFrame:
    """All columns but the text, and ``spans``: array of (kind, start, end, base), by kind as listed, then by start.

    The candidates are written down once, without the text. A column named ``spans`` is replaced.
    """
    narrow = candidates(docs)
    narrow = materialize(narrow.select(*[c for c in docs.columns if c not in ("text", "spans")], "__candidates"), "spans")
    return _decide(narrow, narrow).withColumnRenamed("__spans", "spans")


def _votes(marked: DataFrame) -> DataFrame:
    one = F.explode("__candidates").alias("c")
    return marked.select(one).groupBy(F.col("c.votes").alias("votes")).agg(F.count("*").alias("n"))


def _decide(marked: DataFrame, corpus: DataFrame) -> DataFrame:
    w = fit(_votes(corpus))
    everything = F.col("__candidates")

    def stays(one: Column) -> Column:
        score = F.lit(w[0])
        for j, x in enumerate(w[1:]):
            score = score + F.lit(x) * one["votes"][j]
        apart = ~F.exists(everything, lambda b: b["base"] & (b["start"] < one["end"]) & (one["start"] < b["end"]))
        return one["base"] | (one["kind"].isin(*ADDED) & (score >= 0) & apart)

    return marked.withColumn("__spans", F.transform(F.filter(everything, stays), lambda one: F.struct(
        one["kind"].alias("kind"), one["start"].alias("start"), one["end"].alias("end"), one["base"].alias("base")))
    ).drop("__candidates")


def listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def span_digest(docs: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each base kind, base_sha256 and the list of all spans."""
    found = find_spans(docs.select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The same columns; each span, or run of overlapping spans, of the text is replaced by its kind in brackets.

    ``n_chars`` is counted again if there is such a column.
    """
    marked = candidates(docs)
    # only vote counts are gathered here; the texts are read again rather than written twice
    found = _decide(marked, materialize(candidates(docs.select("text")).select("__candidates").where(
        F.size("__candidates") > 0), "votes"))
    ordered = F.array_sort(F.transform("__spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def replace(state: Column, s: Column) -> Column:
        inside = s["start"] < state["at"]
        kept = F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(inside, state["out"]).otherwise(
                F.concat(state["out"], kept, F.lit("["), F.upper(s["kind"]), F.lit("]"))).alias("out"))

    rest = F.aggregate(ordered, start, replace, lambda state: F.concat(
        state["out"], F.substring(F.col("text"), state["at"] + 1, F.length("text"))))
    out = found.withColumn("text", F.when(F.size("__spans") > 0, rest).otherwise(F.col("text"))).drop("__spans")
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(kind)))
    return out.select(*docs.columns)
