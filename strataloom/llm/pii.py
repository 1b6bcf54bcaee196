"""Personal data: fixed formats, and more of it found from the contexts of what is known.

Entities of fixed format (e-mail, IP address, card and phone number) are seeds.
Every word with four digits or an at sign is a candidate; a candidate that lies
in a seed's span is an instance of that kind. The words around a candidate and
its shape make its patterns. Patterns and instances form a graph, each pair
counted once however often a text is copied. In each round a pattern's
confidence in a kind is the mean confidence of its instances (with ``doubt``
blank instances added), and an instance that is no seed takes the best
confidence of its patterns. Candidates outside all seeds become entities of the
kind that a pattern of at least ``support`` sure instances is ``sure`` of.

Identifiers of several words are found whole: a maximal run of digit groups
joined by single blanks, dots, hyphens or brackets, of two words and four digits
or more, is one candidate with the words around the whole run as its context. A
second graph holds the runs and all candidates outside them. A run outside all
seeds becomes an entity by its own patterns, or of the kind of a word found in
it, and then replaces the words in it; where its words are all found they stay
entities of their own.
Only DataFrame functions are used.

Defined cases: a null text counts as empty and has no spans; rows without an id,
repeated rows and rows with equal ids and different texts each get the spans of
their own text; an empty table gives an empty result. Input columns named like
a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .frames import fresh

KINDS = ("email", "ip", "card", "phone")
#: The formats, written so that a failed start is not tried again inside the same run of characters.
FORMATS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_CANDIDATE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
_GROUP = (
    r"(?:\((?=[0-9]++\)))?+[0-9]++(?:[().-]{1,2}+[0-9]++)*+(?:\)(?=\x20\(?[0-9]))?+"
    r"""(?![^\x20\x09-\x0D"'(\[{<>)\]},.;:!?*#$%&|=])"""
)
_RUN = r"""(?<![^\x20\x09-\x0D"'(\[{<>,;:=])(?<![0-9][,;:=(])\+?+""" + f"{_GROUP}(?:\\x20{_GROUP})++"
_MARKS = r"""["'(\[{<>)\]},.;:!?*#$%&|=]"""
#: Code points of a context that patterns look at.
REACH = 64
_SPAN = "array<struct<kind:int,start:int,end:int>>"
_KEY = ["doc_id", "_text_hash"]


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(c: Column) -> Column:
    d = _digits(c)
    n = F.length(d)

    def worth(k):
        one = F.substring(d, n - k, F.lit(1)).cast("int")
        twice = one * 2
        return F.when(k % 2 == 0, one).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, k: acc + worth(k)) % 10 == 0


def _address(c: Column) -> Column:
    """Four numbers of at most 255, whatever zeros they begin with."""
    parts = F.transform(F.split(c, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.concat(F.lit("0"), F.left(p, F.lit(4))).cast("int") <= 255))


def _dialled(c: Column) -> Column:
    return F.length(_digits(c)).between(8, 15)


_VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda c: F.lit(True), "ip": _address, "card": _luhn, "phone": _dialled,
}


def _cut(docs: DataFrame, pattern: str, hits: str, gaps: str) -> DataFrame:
    """The matches of a pattern in the column ``_text`` and what lies before, between and after them."""
    text = F.col("_text")
    found = text.rlike(pattern)
    none = F.array().cast("array<string>")
    return docs.withColumns(
        {
            hits: F.when(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
            gaps: F.when(found, F.split(text, pattern, -1)).otherwise(none),
        }
    )


def _starts(hits: str, gaps: str) -> Column:
    """Start of each match, in code points."""
    length = lambda c, k: F.char_length(F.get(F.col(c), k))
    return F.aggregate(
        F.sequence(F.lit(1), F.size(hits)),
        F.array(length(gaps, F.lit(0))),
        lambda out, k: F.when(
            k < F.size(hits),
            F.concat(out, F.array(F.element_at(out, -1) + length(hits, k - 1) + length(gaps, k))),
        ).otherwise(out),
    )


def _valid_spans(number: int, kind: str, hits: str, at: str) -> Column:
    valid = _VALID[kind]
    held = F.filter(F.arrays_zip(at, hits), lambda z: valid(z[hits]))
    return F.transform(
        held,
        lambda z: F.struct(
            F.lit(number).alias("kind"), z[at].alias("start"), (z[at] + F.char_length(z[hits])).alias("end")
        ),
    ).cast(_SPAN)


def _with_seeds(docs: DataFrame) -> DataFrame:
    """Adds ``_seeds``: spans of fixed format, by kind and then start."""
    for number, kind in enumerate(KINDS):
        hits, gaps, at = f"_{kind}_hits", f"_{kind}_gaps", f"_{kind}_at"
        docs = _cut(docs, FORMATS[kind], hits, gaps).withColumn(
            at, F.when(F.size(hits) > 0, _starts(hits, gaps)).otherwise(F.array().cast("array<int>"))
        )
        docs = docs.withColumn(f"_{kind}", _valid_spans(number, kind, hits, at)).drop(hits, gaps, at)
    parts = [f"_{k}" for k in KINDS]
    return docs.withColumn("_seeds", F.concat(*parts)).drop(*parts)


def _shape(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"\p{L}+", "a"), "[0-9]", "9")


def _with_candidates(docs: DataFrame, pattern: str, marks: str, out: str) -> DataFrame:
    """Adds ``out``: start, end, lower-cased token and its patterns; ``marks`` around a match do not belong to it."""
    docs = _cut(docs, pattern, "_hits", "_gaps")
    docs = docs.withColumn(
        "_at", F.when(F.size("_hits") > 0, _starts("_hits", "_gaps")).otherwise(F.array().cast("array<int>"))
    )
    empty = F.lit("")
    before = lambda k: F.coalesce(F.right(F.get("_gaps", k), F.lit(REACH)), empty)
    after = lambda k: F.coalesce(F.left(F.get("_gaps", k + 1), F.lit(REACH)), empty)

    def one(k):
        hit = F.get("_hits", k)
        bare = F.regexp_replace(hit, f"^{marks}+", "") if marks else hit
        token = F.regexp_replace(bare, f"{marks}+$", "") if marks else bare
        start = F.get("_at", k) + F.char_length(hit) - F.char_length(bare)
        words = F.filter(F.split(F.lower(before(k)), r"[\x20\x09-\x0D]+"), lambda w: w != "")
        last, but_one = F.try_element_at(words, F.lit(-1)), F.try_element_at(words, F.lit(-2))
        following = F.try_element_at(F.filter(F.split(F.lower(after(k)), r"[\x20\x09-\x0D]+"), lambda w: w != ""), F.lit(1))
        shape = _shape(token)
        patterns = F.array(
            F.concat(F.lit("shape\t"), shape),
            F.concat(F.lit("words\t"), but_one, F.lit(" "), last),
            F.concat(F.lit("left\t"), last, F.lit("\t"), shape),
            F.concat(F.lit("right\t"), following, F.lit("\t"), shape),
        )
        return F.struct(
            start.alias("start"),
            (start + F.char_length(token)).alias("end"),
            F.lower(token).alias("token"),
            F.filter(patterns, lambda p: p.isNotNull()).alias("patterns"),
        )

    every = F.when(
        F.size("_hits") > 0, F.transform(F.sequence(F.lit(0), F.size("_hits") - 1), one)
    ).otherwise(F.array())
    return docs.withColumn(
        out,
        F.filter(every, lambda c: (F.length(_digits(c["token"])) >= 4) | c["token"].contains("@")),
    ).drop("_hits", "_gaps", "_at")


def _scan(docs: DataFrame) -> DataFrame:
    """doc_id, hash of the text, seeds, candidates and runs of every row; without the texts."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    text = text.withColumn("_text_hash", F.xxhash64("_text"))
    words = _with_candidates(_with_seeds(text), _CANDIDATE, _MARKS, "_candidates")
    return _with_candidates(words, _RUN, "", "_runs").drop("_text")


def _confidence(edges: DataFrame, seeds: DataFrame, rounds: int, doubt: float, support: int) -> DataFrame:
    """pattern, kind, confidence and sure instances, after ``rounds`` rounds over the graph.

    ``edges`` holds (pattern, token) pairs, ``seeds`` (token, kind) pairs.
    """
    degree = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("degree"))
    known = seeds.withColumn("confidence", F.lit(1.0))
    instances = known
    patterns = None
    for k in range(rounds):
        patterns = pin(
            edges.join(instances, "token")
            .groupBy("pattern", "kind")
            .agg(F.sum("confidence").alias("mass"), F.sum((F.col("confidence") >= 0.5).cast("int")).alias("firm"))
            .join(degree, "pattern")
            .select("pattern", "kind", "firm", (F.col("mass") / (F.col("degree") + F.lit(doubt))).alias("confidence")),
            "patterns",
        )
        if k + 1 == rounds:
            break
        spread = (
            edges.join(patterns.filter(F.col("firm") >= support).select("pattern", "kind", "confidence"), "pattern")
            .groupBy("token", "kind")
            .agg(F.max("confidence").alias("confidence"))
            .join(known.select("token"), "token", "left_anti")
        )
        instances = pin(known.unionByName(spread), "instances")
    return patterns


def spans(
    docs: DataFrame, rounds: int = 3, sure: float = 0.8, support: int = 5, doubt: float = 1.0
) -> DataFrame:
    """doc_id, _text_hash, seeds and added (arrays of kind, start, end) for every row."""
    found = pin(_scan(docs), "pii")
    options = (rounds, sure, support, doubt)
    words = _bootstrapped(found, F.col("_candidates"), *options)
    outside = F.filter("_candidates", lambda c: ~F.exists("_runs", lambda r: _overlap(c, r)))
    whole = _bootstrapped(found, F.concat("_runs", outside), *options)
    same = lambda t: F.col("doc_id").eqNullSafe(F.col(f"_id_{t}")) & (F.col("_text_hash") == F.col(f"_hash_{t}"))
    named = lambda df, t: df.toDF(f"_id_{t}", f"_hash_{t}", f"_of_{t}")
    none = F.array().cast(_SPAN)
    both = found.join(named(words, "words"), same("words"), "left").join(named(whole, "whole"), same("whole"), "left")
    both = both.withColumns({c: F.coalesce(c, none) for c in ("_of_words", "_of_whole")})

    def entity(r):
        """A run's entity: by its own patterns, else by a word found in it; null for none, or if its words are all found."""
        own = F.get(F.filter("_of_whole", lambda s: (s["start"] == r["start"]) & (s["end"] == r["end"])), F.lit(0))
        words = F.filter("_of_words", lambda s: _overlap(s, r))
        inner = F.get(words, F.lit(0))
        found = F.aggregate(words, F.lit(-1), lambda n, s: n + s["end"] - s["start"] + 1)
        seeded = F.exists("_seeds", lambda s: _overlap(s, r))
        kind = F.when(~seeded & (found < r["end"] - r["start"]), F.coalesce(own["kind"], inner["kind"]))
        return F.struct(kind.alias("kind"), r["start"].alias("start"), r["end"].alias("end"))

    both = both.withColumn("_whole", F.filter(F.transform("_runs", entity), lambda s: s["kind"].isNotNull()).cast(_SPAN))
    apart = F.filter("_of_words", lambda s: ~F.exists("_whole", lambda r: _overlap(s, r)))
    return both.select(*_KEY, F.col("_seeds").alias("seeds"), F.sort_array(F.concat("_whole", apart)).alias("added"))


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (a["end"] > b["start"])


def _bootstrapped(
    found: DataFrame, candidates: Column, rounds: int, sure: float, support: int, doubt: float
) -> DataFrame:
    """doc_id, _text_hash and the spans that the graph of the candidates adds to the seeds, where there are any."""
    one = found.select(*_KEY, "_seeds", F.explode(candidates).alias("_c"))
    inside = F.array_min(
        F.transform(
            F.filter("_seeds", lambda s: _overlap(s, F.col("_c"))),
            lambda s: s["kind"],
        )
    )
    each = pin(one.withColumn("kind", inside).select(*_KEY, "kind", "_c.*"), "candidates")
    edges = pin(each.select("token", F.explode("patterns").alias("pattern")).distinct(), "edges")
    seeds = each.filter("kind is not null").select("token", "kind").distinct()
    trusted = (
        _confidence(edges, seeds, rounds, doubt, support)
        .filter((F.col("confidence") >= sure) & (F.col("firm") >= support))
        .groupBy("pattern")
        .agg(F.max(F.struct("confidence", -F.col("kind"))).alias("_best"))
        .select("pattern", "_best.confidence", (-F.col("_best.col2")).alias("_kind"))
    )
    return (
        each.filter("kind is null")
        .select(*_KEY, "start", "end", F.explode("patterns").alias("pattern"))
        .join(trusted, "pattern")
        .groupBy(*_KEY, "start", "end")
        .agg(F.max(F.struct("confidence", -F.col("_kind"))).alias("_best"))
        .groupBy(*_KEY)
        .agg(
            F.sort_array(
                F.collect_list(F.struct((-F.col("_best.col2")).alias("kind"), F.col("start"), F.col("end")))
            ).cast(_SPAN).alias("added")
        )
    )


def as_text(found: Column) -> Column:
    """kind:start:end of each span, comma-joined, by kind as listed and then by start."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(F.sort_array(found), one), ",")


def redact(docs: DataFrame, **options) -> DataFrame:
    """All rows and columns; in ``text`` each entity is replaced by its kind in brackets.

    Of entities that overlap, the first names the replacement and all of them go.
    """
    text_hash, held, key = fresh("hash"), fresh("spans"), fresh("id")
    found = (
        spans(docs, **options)
        .select(
            F.col("doc_id").alias(key), F.col("_text_hash").alias(text_hash), F.concat("seeds", "added").alias(held)
        )
        .filter(F.size(held) > 0)
        .dropDuplicates([key, text_hash])
    )
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(text_hash))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_start = F.array_sort(F.transform(held, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    text = F.col("text")
    kept = F.aggregate(
        by_start,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"])
                ).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))),
    )
    cleaned = F.when(F.col(held).isNotNull(), kept).otherwise(text)
    return docs.join(found, same, "left").select(
        *[cleaned.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    )
