"""Secrets in texts: fixed patterns, and strings that a character Markov model takes for random.

Three patterns give the base spans. A fourth kind is added by two character Markov chains, one of
random strings and one of ordinary identifiers: a run of at least ``LEAST`` token characters is a
secret if the log-likelihood ratio of the two chains exceeds ``ODDS`` and no base span overlaps it.

``learn`` trains both chains from labelled strings of all documents: ordinary are the runs left when
the base matches are taken out, and the identifiers that writers of code make of such words; random
are the values that the patterns matched and ``GENERATED`` strings from a hash (so that the chain is not
one of the corpus' own keys only). Words are counted before they are cut into pairs of characters, so a frequent word costs one row. The
model is one row of 128 x 128 whole numbers, whatever the input, and sums of whole numbers do not
depend on their order.

DataFrame functions throughout. Positions are code points, ends exclusive.

Defined cases: a null text counts as empty (no spans); null ids, ties and repeated rows are kept, one
result per row; an empty table gives no rows; without any base match or word the chains are those of
the generated strings and of even chances; columns other than the two asked for are not read, so
their names are free; a text of any length is read whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Kinds in the order of the span lists, their patterns, and the least length.
ASSIGN = r"""(?=[pstaPSTA])(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs are maximal, so a least length in the pattern drops the same matches as one tested afterwards.
#: That does not hold for ASSIGN, whose short matches use up text.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
LEAST_VALUE = 12
KINDS = ("assign", "access", "hex", "random")

TOKEN = "[A-Za-z0-9+/_=-]"
RUN = f"{TOKEN}+"
#: Stands before a labelled random string while words are counted; no token holds it.
MARK = "!"
#: Token characters and the end of a word.
SYMBOLS = 68
#: Shortest run that is judged.
LEAST = 16
#: A run is a secret if it is that much likelier under the random chain, times ``SCALE``.
SCALE = 1024
ODDS = round(SCALE * math.log(1_000_000))
#: Labelled random strings that come from a hash, beside those that the patterns match.
GENERATED = 1000
#: A word counts so often, for once that it counts as each kind of identifier made of it.
MADE = 8
JOINTS = "_-/"
#: Rows of ``_located`` that are appended to its list at once.
CHUNK = 512


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _located(body: Column, pattern: str) -> Column:
    """``array<struct<start, end, text>>`` of the matches, leftmost and not overlapping.

    The pieces between the matches and the matches themselves alternate, so their lengths add up to
    the positions; they are added in chunks, since a list that grows by one element is copied each
    time. A text without a match is searched once and not split."""
    none = F.expr("cast(array() AS array<struct<start: bigint, end: bigint, text: string>>)")

    def step(acc: Column, part: Column) -> Column:
        start = acc["at"] + F.length(part["gap"])
        end = start + F.length(part["text"])
        span = F.struct(start.alias("start"), end.alias("end"), part["text"].alias("text"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    def chunk(parts: Column, acc: Column, first: Column) -> Column:
        some = F.filter(F.slice(parts, first, F.lit(CHUNK)), lambda x: x["text"].isNotNull())
        more = F.aggregate(some, F.struct(acc["at"].alias("at"), none.alias("spans")), step)
        return _let(more, lambda m: F.struct(m["at"].alias("at"), F.concat(acc["spans"], m["spans"]).alias("spans")))

    def place(found: Column) -> Column:
        parts = F.arrays_zip(F.split(body, pattern, -1).alias("gap"), found.alias("text"))
        firsts = F.sequence(F.lit(1), F.size(found), F.lit(CHUNK))
        start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))
        return _let(parts, lambda p: F.aggregate(firsts, start, lambda a, first: chunk(p, a, first), lambda a: a["spans"]))

    every = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
    return _let(every, lambda found: F.when(F.size(found) == 0, none).otherwise(place(found)))


def _of_kind(body: Column, kind: int) -> Column:
    """``array<struct<start, kind, end>>``, which sorts by start and then kind."""
    spans = _located(body, (ASSIGN, ACCESS, HEX)[kind])
    if kind == 0:
        spans = F.filter(spans, lambda s: F.length(F.regexp_extract(s["text"], ASSIGN, 1)) >= LEAST_VALUE)
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"))
    )


def labelled(docs: DataFrame, text: str = "text") -> DataFrame:
    """``random boolean, word, n``: the labelled strings of all documents and how often they occur."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    of = lambda pattern, group: F.regexp_extract_all(body, F.lit(pattern), F.lit(group))
    values = F.concat(F.filter(of(ASSIGN, 1), lambda v: F.length(v) >= LEAST_VALUE), of(ACCESS, 0), of(HEX, 0))
    rest = F.when(F.size(F.col("found")) > 0, F.regexp_replace(body, f"{ASSIGN}|{ACCESS}|{HEX}", " ")).otherwise(body)
    marked = F.flatten(
        F.transform(
            "found",
            lambda v: F.transform(F.regexp_extract_all(v, F.lit(RUN), F.lit(0)), lambda w: F.concat(F.lit(MARK), w)),
        )
    )
    words = (
        docs.select(body.alias(text), values.alias("found"))
        .select(F.explode(F.concat(F.regexp_extract_all(rest, F.lit(RUN), F.lit(0)), marked)).alias("word"))
        .groupBy("word").agg(F.count("*").alias("n"))
    )
    told = F.startswith("word", F.lit(MARK))
    words = words.select(told.alias("random"), F.when(told, F.substring("word", 2, 1 << 30)).otherwise(F.col("word")).alias("word"), "n")
    made = docs.sparkSession.range(GENERATED).select(
        F.lit(True).alias("random"),
        F.base64(F.unhex(F.sha2(F.col("id").cast("string"), 256))).alias("word"),
        F.lit(1).cast("long").alias("n"),
    )
    return words.unionByName(made)


def _pairs(word: Column) -> Column:
    """128 p + c for each character c and the one before it, p; a blank stands at both ends."""
    codes = F.transform(F.split(F.concat(F.lit(" "), word, F.lit(" ")), ""), lambda c: F.ascii(c).cast("long"))
    return _let(
        codes,
        lambda c: F.transform(F.sequence(F.lit(1), F.size(c) - 1), lambda i: F.get(c, i - 1) * 128 + F.get(c, i)),
    )


def _identifiers(counts: DataFrame) -> DataFrame:
    """Counts of the ordinary pairs in words, ``MADE`` times, and of those in identifiers made of the
    words: in capitals, in camel case, and joined by each of ``JOINTS``."""
    p, c = F.floor(F.col("code") / 128), F.pmod("code", F.lit(128))
    small = lambda x: x.between(97, 122)
    letter = lambda x: small(x) | x.between(65, 90)
    capital = lambda x: F.when(small(x), x - 32).otherwise(x)
    pair = lambda n, first, second: F.struct((first * 128 + second).cast("long").alias("code"), (F.col("o") * n).alias("o"))
    blank, joints = F.lit(32), [F.lit(ord(x)) for x in JOINTS]
    made = (
        F.when(letter(p) & letter(c), F.array(pair(1, capital(p), capital(c)), pair(1, p, capital(c))))
        .when((p == 32) & letter(c), F.array(*[pair(1, x, y) for x in [blank, *joints] for y in (c, capital(c))]))
        .when(letter(p) & (c == 32), F.array(*[pair(1, x, y) for x in (p, capital(p)) for y in joints]))
        .otherwise(F.array().cast("array<struct<code:bigint,o:bigint>>"))
    )
    rows = counts.select(F.explode(F.concat(F.array(F.struct("code", (F.col("o") * MADE).alias("o"))), made)).alias("x"))
    return rows.groupBy("x.code").agg(F.sum("x.o").alias("o"))


def learn(strings: DataFrame) -> DataFrame:
    """One row, ``weights array<long>``: the scaled log-likelihood ratio of the character with code c
    after the one with code p at 128 p + c."""
    pairs = strings.where("word <> ''").select("random", "n", F.explode(_pairs(F.col("word"))).alias("code"))
    seen = pairs.groupBy("code").agg(
        F.sum(F.when(F.col("random"), F.col("n")).otherwise(0)).alias("r"),
        F.sum(F.when(F.col("random"), 0).otherwise(F.col("n"))).alias("o"),
    )
    # From here on every table has at most 16,384 rows, a bound of the code and not of the data.
    both = seen.select("code", "r", F.lit(0).cast("long").alias("o")).unionByName(
        _identifiers(seen.where("o > 0")).withColumn("r", F.lit(0).cast("long"))
    )
    cells = strings.sparkSession.range(128 * 128).select(
        F.col("id").alias("code"), F.lit(0).cast("long").alias("r"), F.lit(0).cast("long").alias("o")
    )
    counts = both.unionByName(cells).groupBy("code").agg(F.sum("r").alias("r"), F.sum("o").alias("o"))
    after = Window.partitionBy(F.floor(F.col("code") / 128))
    counts = counts.withColumns({"rs": F.sum("r").over(after), "os": F.sum("o").over(after)})
    chance = lambda one, of: F.ln((F.col(one) + 1.0) / (F.col(of) + float(SYMBOLS)))
    weight = F.round(SCALE * (chance("r", "rs") - chance("o", "os"))).cast("long")
    ordered = F.sort_array(F.collect_list(F.struct("code", weight.alias("w"))))
    return counts.agg(F.transform(ordered, lambda x: x["w"]).alias("weights"))


def score(word: Column, weights: Column) -> Column:
    """Scaled log-likelihood ratio of a string of token characters."""
    return F.aggregate(_pairs(word), F.lit(0).cast("long"), lambda s, code: s + F.get(weights, code.cast("int")))


def find(docs: DataFrame, model: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, spans, base``: arrays of ``struct<start, kind, end>`` by start and kind (an index of
    ``KINDS``), all spans and those of the patterns. ``model`` is a result of ``learn``."""
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"),
        model.scalar().alias("weights"),
    )
    body = F.col("body")
    rows = rows.withColumn("base", F.sort_array(F.concat(*[_of_kind(body, k) for k in range(3)])))
    judged = F.filter(
        _located(body, f"(?<!{TOKEN}){TOKEN}{{{LEAST},}}"),
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        & (score(s["text"], F.col("weights")) > ODDS),
    )
    added = F.transform(
        judged, lambda s: F.struct(s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end"))
    )
    return rows.select("doc_id", F.sort_array(F.concat("base", added)).alias("spans"), "base")


def told(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redact(body: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span's characters replaced; overlapping spans become one mark."""
    merged = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.when(
                    (s["start"] < a["at"]), a["out"]
                ).otherwise(
                    F.concat(a["out"], F.substr(body, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mark))
                ).alias("out"),
            )
        ),
    )
    return _let(merged, lambda m: F.concat(m["out"], F.substr(body, (m["at"] + 1).cast("int"))))
