"""Personal data by weak supervision.  DataFrame functions only.

Patterns propose spans; four labelers vote on each: its form, a gazetteer, cue words
before it, and its neighbours.  Expectation-maximisation on the counts of vote patterns
estimates how reliable each labeler is, and the posteriors train the span classifier.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import settled, whole_rows

#: In the order in which spans that start together are listed.
KINDS = ("email", "ip", "card", "phone")

#: The base patterns.  Possessive where nothing has to be given back, and anchored at the
#: start of a run of signs (or at the end of the last match), so that a long run is read once.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser forms; the classifier decides on them.
LOOSE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "phone": r"(?<![0-9+)(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
#: Signs without which a text cannot match.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
LOOSE_NEEDS = {"email": "at", "ip": ":", "phone": None}

#: Endings of domains, country calling codes and issuer numbers in common use,
#: and addresses that belong to no host.
DOMAIN_ENDINGS = "com|org|net|edu|gov|mil|info|biz|io|dev|app|de|fr|es|it|nl|at|ch|be|uk|ie|us|ca|au|nz|jp|cn|in|br|mx|ru|pl|se|no|dk|fi|pt|cz|gr|tr|za|kr|eu"
CALLING_CODES = "1|7|20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|51|52|53|54|55|56|57|58|60|61|62|63|64|65|66|81|82|84|86|90|91|92|93|94|95|98|2[1-9][0-9]|3[578][0-9]|42[0-9]|5[09][0-9]|6[7-9][0-9]|8[0578][0-9]|9[679][0-9]"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|35|36|38|6011|62|64|65|50|67"
NO_HOST = r"0\.|127\.|169\.254\.|22[4-9]\.|2[3-5][0-9]\."
CUES = {
    "email": "mail|contact|write to|reach|kontakt|correo|courriel",
    "ip": r"\bip\b|address|host|server|login|adresse|client",
    "card": "card|visa|master|credit|debit|payment|karte|tarjeta|carte",
    "phone": r"phone|\btel\b|call|mobile|fax|telefon|contact",
}
COUNTER_CUES = {
    "email": "version|package|git",
    "ip": "version|release|section|chapter",
    "card": "isbn|order|serial|token|sha|hash|commit",
    "phone": "isbn|order|serial|invoice|version",
}
CONTEXT = 40
LABELERS = ("form", "gazetteer", "cue", "edges")
SHAPES = ("length", "parted")


def _has(text: Column, sign: str | None) -> Column:
    return text.rlike("[0-9]") if sign is None else F.contains(text, F.lit(sign))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, also where the body asks for it again
    and again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, b: a + b)


def _sums_before(numbers: Column) -> Column:
    """For each number the sum of those before it, in blocks: no step looks at all of them."""
    width = 64

    def by_block(all_: Column) -> Column:
        count = F.floor((F.size(all_) - 1) / width).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), count), lambda b: F.slice(all_, b * width + 1, F.lit(width)))
        return _let(
            blocks,
            lambda cut: _let(
                F.transform(cut, _sum),
                lambda sums: F.flatten(
                    F.transform(
                        cut,
                        lambda block, k: _let(
                            _sum(F.slice(sums, F.lit(1), k)),
                            lambda start: F.transform(block, lambda _, i: start + _sum(F.slice(block, F.lit(1), i))),
                        ),
                    )
                ),
            ),
        )

    return _let(numbers, by_block)


def _found(text: Column, pattern: str, needs: str | None) -> Column:
    """All matches, leftmost and non-overlapping."""
    nothing = F.array().cast("array<string>")
    return F.when(_has(text, needs), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(nothing)


def _places(values: Column, gaps: Column) -> Column:
    """Structs (start, end, value, before, after) in code points.

    Java's find gives the values, its split the texts between them; the lengths add up."""
    n = F.size(values)
    steps = F.zip_with(
        F.zip_with(values, F.slice(gaps, F.lit(1), n), lambda v, g: F.struct(v.alias("value"), g.alias("gap"))),
        F.slice(gaps, F.lit(2), n),
        lambda s, after: F.struct(
            s["value"].alias("value"),
            F.length(s["gap"]).cast("bigint").alias("skip"),
            F.substring(s["gap"], -CONTEXT, CONTEXT).alias("before"),
            F.substring(after, 1, 1).alias("after"),
        ),
    )
    return _let(
        steps,
        lambda all_: F.zip_with(
            all_,
            _sums_before(F.transform(all_, lambda s: s["skip"] + F.length(s["value"]))),
            lambda s, at: F.struct(
                (at + s["skip"]).alias("start"),
                (at + s["skip"] + F.length(s["value"])).alias("end"),
                s["value"].alias("value"),
                s["before"].alias("before"),
                s["after"].alias("after"),
            ),
        ),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    """Whether a base match passes the check of its kind."""
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(14, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _gazetteer(kind: str, value: Column) -> Column:
    if kind == "email":
        known = F.lower(value).rlike(rf"\b(?:{DOMAIN_ENDINGS})$")
    elif kind == "ip":
        known = ~value.rlike(f"^(?:{NO_HOST})")
    elif kind == "card":
        known = _digits(value).rlike(f"^(?:{ISSUERS})")
    else:
        return _vote(value.rlike(rf"^\+(?:{CALLING_CODES})"), F.substring(value, 1, 1) == "+")
    return _vote(known, ~known)


def _candidates(kind: str, places: Column, strict: bool) -> Column:
    """Spans with votes and shape.  Of the strict pattern's matches, those that fail their
    check are proposed too where they have the length of a card number."""

    def span(m: Column) -> Column:
        value = m["value"]
        valid = _valid(kind, value) if strict else F.lit(False)
        open_ = ~F.coalesce(F.substring(m["before"], -1, 1), F.lit("")).rlike(r"[\p{L}\p{N}]") & ~F.coalesce(
            m["after"], F.lit("")
        ).rlike(r"[\p{L}\p{N}]")
        before = F.lower(m["before"])
        return F.struct(
            m["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("order"),
            m["end"].alias("end"),
            F.lit(kind).alias("kind"),
            valid.alias("base"),
            (_vote(valid, ~valid) if strict else F.lit(0)).alias("form"),
            _gazetteer(kind, value).alias("gazetteer"),
            _vote(before.rlike(CUES[kind]), before.rlike(COUNTER_CUES[kind])).alias("cue"),
            _vote(open_, ~open_).alias("edges"),
            F.least(F.floor(F.length(value) / 6), F.lit(6)).cast("int").alias("length"),
            value.rlike(r"[ ()\[\]-]").cast("int").alias("parted"),
        )

    proposed = places
    if strict and kind == "card":
        proposed = F.filter(places, lambda m: F.length(_digits(m["value"])).between(14, 19))
    spans = F.transform(proposed, span)
    return spans if kind == "card" else F.filter(spans, lambda s: s["base"]) if strict else spans


def candidates(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """``id, spans`` (every candidate of the row, by start) and, with ``carry``, ``row``."""
    rows = whole_rows(docs, id=F.col(f"`{id_col}`"), text=F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    text = F.col("text")
    sets = [(f"{k}_base", k, BASE[k], NEEDS[k], True) for k in KINDS]
    sets += [(f"{k}_loose", k, LOOSE[k], LOOSE_NEEDS[k], False) for k in LOOSE]
    found = rows.select("*", *(_found(text, pattern, needs).alias(name) for name, _, pattern, needs, _ in sets))
    cut = found.select(
        "*",
        *(
            F.when(F.size(name) > 0, F.split(text, pattern, -1)).alias(f"{name}_gaps")
            for name, _, pattern, _, _ in sets
        ),
    )
    keep = ["id", *(["row"] if carry else [])]
    placed = cut.select(
        *keep,
        *(
            F.when(F.size(name) > 0, _candidates(kind, _places(F.col(name), F.col(f"{name}_gaps")), strict)).alias(name)
            for name, kind, _, _, strict in sets
        ),
    )
    base = F.flatten(F.filter(F.array(*(F.col(f"{k}_base") for k in KINDS)), lambda a: a.isNotNull()))
    loose = F.flatten(F.filter(F.array(*(F.col(f"{k}_loose") for k in LOOSE)), lambda a: a.isNotNull()))
    joined = placed.select(*keep, base.alias("base"), loose.alias("loose"))
    spans = _let(
        F.col("base"),
        lambda held: F.concat(
            held,
            F.filter(
                F.col("loose"),
                lambda s: ~F.exists(held, lambda b: b["base"] & (b["start"] < s["end"]) & (s["start"] < b["end"])),
            ),
        ),
    )
    return joined.select(*keep, F.sort_array(spans).alias("spans"))


# -- what the counts teach ---------------------------------------------------------------


def reliabilities(counts: dict[tuple[int, ...], float], rounds: int = 60) -> tuple[float, list[dict[int, list[float]]]]:
    """Expectation-maximisation for one kind: the share of true spans and, for each labeler,
    ``vote -> [chance if false, chance if true]``.

    Labelers are taken to err independently.  The starting values, also used as prior
    counts, say that they are right more often than wrong, and the check of the form
    (digits, parts, lengths) much more often."""
    weak, sure = {1: (1.0, 4.0), 0: (2.0, 2.0), -1: (4.0, 1.0)}, {1: (1.0, 40.0), 0: (8.0, 8.0), -1: (40.0, 1.0)}
    prior = [sure if labeler == "form" else weak for labeler in LABELERS]
    table = [{v: [p[y] / sum(q[y] for q in own.values()) for y in (0, 1)] for v, p in own.items()} for own in prior]
    share = 0.5
    for _ in range(rounds):
        sums = [{v: list(p) for v, p in own.items()} for own in prior]
        true = total = 1.0
        for votes, n in counts.items():
            p = posterior(votes, share, table)
            true, total = true + n * p, total + n
            for own, v in zip(sums, votes, strict=True):
                own[v][0] += n * (1 - p)
                own[v][1] += n * p
        share = min(max(true / (total + 1.0), 1e-3), 1 - 1e-3)
        table = [{v: [own[v][y] / sum(own[w][y] for w in own) for y in (0, 1)] for v in own} for own in sums]
    return share, table


def posterior(votes: tuple[int, ...], share: float, table: list[dict[int, list[float]]]) -> float:
    odds = math.log(share / (1 - share)) + sum(
        math.log(t[v][1] / t[v][0]) for t, v in zip(table, votes, strict=True)
    )
    return 1 / (1 + math.exp(-max(min(odds, 50.0), -50.0)))


def train(rows: list) -> dict[str, float]:
    """Weights of the span classifier from counts by kind, votes and shape.

    A naive Bayes model on votes and shape, with the posteriors as soft labels; keys are
    ``kind`` for the prior and ``kind|feature|value``.
    """
    weights: dict[str, float] = {}
    for kind in KINDS:
        own = [r for r in rows if r["kind"] == kind]
        counts: dict[tuple[int, ...], float] = {}
        for r in own:
            votes = tuple(r[x] for x in LABELERS)
            counts[votes] = counts.get(votes, 0.0) + r["n"]
        share, table = reliabilities(counts)
        weights[kind] = math.log(share / (1 - share))
        for labeler, chances in zip(LABELERS, table, strict=True):
            for vote, (false, true) in chances.items():
                weights[f"{kind}|{labeler}|{vote}"] = math.log(true / false)
        for shape in SHAPES:
            values = sorted({r[shape] for r in own})
            sums = {v: [1.0, 1.0] for v in values}
            for r in own:
                p = posterior(tuple(r[x] for x in LABELERS), share, table)
                sums[r[shape]][0] += r["n"] * (1 - p)
                sums[r[shape]][1] += r["n"] * p
            all_ = [sum(s[y] for s in sums.values()) for y in (0, 1)]
            for v, (false, true) in sums.items():
                weights[f"{kind}|{shape}|{v}"] = math.log(true / all_[1]) - math.log(false / all_[0])
    return weights


def _scored(spans: Column, weights: dict[str, float]) -> Column:
    known = F.create_map(*(F.lit(x) for item in weights.items() for x in item))

    def score(s: Column) -> Column:
        parts = [F.try_element_at(known, s["kind"])] + [
            F.try_element_at(known, F.concat(s["kind"], F.lit(f"|{f}|"), s[f].cast("string"))) for f in (*LABELERS, *SHAPES)
        ]
        odds = reduce(lambda a, b: a + b, (F.coalesce(p, F.lit(0.0)) for p in parts))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))

    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"),
            s["kind"].alias("kind"), s["base"].alias("base"), score(s).alias("score"),
        ),
    )


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False, threshold: float = 0.5) -> DataFrame:
    """One row per input row: ``id, spans`` and, with ``carry``, the input row as ``row``.

    ``spans`` are structs (start, order, end, kind, base, score) by start, then kind as
    listed; places are code points, the end exclusive.  All base spans stay; others are
    added if the classifier gives them ``threshold`` or more and no base span overlaps
    them.  Spans of different kinds may overlap.  NULL counts as empty text, which has no
    spans.  The counts that train the classifier cover every row.
    """
    proposed = settled(candidates(docs, id_col, text_col, carry), "spans")
    # At most four kinds, 81 vote patterns, 7 lengths and two forms.
    rows = (
        proposed.select(F.explode("spans").alias("s")).select("s.*")
        .groupBy("kind", *LABELERS, *SHAPES).agg(F.count("*").alias("n")).collect()
    )
    scored = proposed.withColumn("spans", _scored(F.col("spans"), train(rows)))
    return scored.withColumn("spans", F.filter("spans", lambda s: s["base"] | (s["score"] >= threshold)))


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans are one,
    named after the first."""
    nothing = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")

    def span(start: Column, end: Column, kind: Column) -> Column:
        return F.array(F.struct(start.alias("start"), end.alias("end"), kind.alias("kind")))

    def join(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        return F.when(
            (F.size(done) > 0) & (last["end"] > s["start"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                span(last["start"], F.greatest(last["end"], s["end"]), last["kind"]),
            ),
        ).otherwise(F.concat(done, span(s["start"], s["end"], s["kind"])))

    def rebuilt(apart: Column) -> Column:
        begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(apart, lambda s: s["end"]))
        parts = F.zip_with(
            apart,
            F.slice(begins, F.lit(1), F.size(apart)),
            lambda s, begin: F.concat(
                F.substring(text, (begin + 1).cast("int"), (s["start"] - begin).cast("int")),
                F.lit("["),
                F.upper(s["kind"]),
                F.lit("]"),
            ),
        )
        end = F.element_at(apart, -1)["end"].cast("int")
        return F.concat(F.array_join(parts, ""), F.substring(text, end + 1, F.length(text)))

    return F.when(F.size(spans) > 0, _let(F.aggregate(spans, nothing, join), rebuilt)).otherwise(text)


def redact_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The input rows, all columns, with personal data replaced; ``length_col``, if there is
    one, is the new text's length.  NULL text stays NULL."""
    found = find_pii(docs, id_col, text_col, carry=True)
    done = found.withColumn("clean", redacted(F.col("row")[text_col], F.col("spans")))
    columns = []
    for f in docs.schema.fields:
        if f.name == text_col:
            columns.append(F.col("clean").alias(f.name))
        elif f.name == length_col and text_col in docs.columns:
            columns.append(F.coalesce(F.length("clean").cast(f.dataType), F.col("row")[f.name]).alias(f.name))
        else:
            columns.append(F.col("row")[f.name].alias(f.name))
    return done.select(*columns)
