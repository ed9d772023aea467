"""Quality rules as a ledger: each rule is evaluated once, its failure is one bit of a mask.

``measure`` adds measurements, ``record`` adds the failure mask, ``apply_policy`` keeps the documents
that fail none of a policy's rules, ``ablation`` counts by bitwise aggregation what each rule of a
policy decides. A new policy needs the ledger only, not the texts. DataFrame functions throughout.

Defined cases: a null text counts as empty (no words: fails ``few_words``); null ids, ties and
repeated rows are kept as they are, one ledger row per input row; an empty table gives an empty
ledger; columns other than the text are carried along and may have any name, but those named as a
ledger column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
#: Letters of scripts that write words with few of them, or without blanks.
WIDE = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}\p{IsBopomofo}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` (SQL over the measurements) is true; it never is null."""

    bit: int
    name: str
    fails: str


#: The bits are stored, so a rule keeps its bit for good; new rules take new bits.
RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "5 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule(4, "short_words", "2 * word_chars < 5 * n_words AND 2 * n_wide < word_chars"),
    Rule(5, "long_words", "word_chars > 40 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: r.bit for r in RULES}
        return reduce(lambda m, name: m | 1 << bits[name], self.rules, 0)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STANDARD = Policy("standard", 1, tuple(r.name for r in RULES))
MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_wide")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda's variable is never inlined, whereas a
    column used inside another lambda would be computed again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(hashes: Column) -> Column:
    """Words that lie in a window found twice or more, from the windows' hashes in order.

    Windows are sorted by hash to find those with an equal neighbour, then by place; each adds the
    words up to the next such window, ``WINDOW`` at most."""
    placed = F.sort_array(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    marked = _let(
        placed,
        lambda p: F.transform(
            p,
            lambda x, j: F.when(
                ((j > 0) & (F.get(p, j - 1)["h"] == x["h"])) | (F.get(p, j + 1)["h"] == x["h"]),
                x["i"],
            ),
        ),
    )
    return F.aggregate(
        F.sort_array(F.array_compact(marked)),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).cast("long").alias("n"),
            i.cast("int").alias("last"),
        ),
        lambda a: a["n"],
    )


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measurements, all long; ``n_wide`` is counted where words are short."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    out = docs.drop(*[c for c in docs.columns if c.lower() in {*MEASUREMENTS, "_word_facts", "_line_facts"}])
    facts = _let(F.filter(F.split(body, f"{SPACE}+"), lambda w: w != ""), _word_facts)
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    line_facts = _let(
        lines,
        lambda x: F.struct(
            F.size(x).alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
        ),
    )
    out = out.withColumns(
        {
            "_word_facts": facts,
            "_line_facts": line_facts,
            "word_chars": (F.length(body) - F.regexp_count(body, F.lit(SPACE))).cast("long"),
            "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
        }
    )
    flat = {"n_words": "_word_facts", "n_repeat_words": "_word_facts",
            "n_lines": "_line_facts", "n_dup_lines": "_line_facts"}
    out = out.withColumns({c: F.col(f"{f}.{c}").cast("long") for c, f in flat.items()}).drop(
        "_word_facts", "_line_facts"
    )
    # Only short words need it: zero elsewhere.
    short = F.expr("2 * word_chars < 5 * n_words")
    return out.withColumn("n_wide", F.when(short, F.regexp_count(body, F.lit(WIDE))).otherwise(0).cast("long"))


def _word_facts(words: Column) -> Column:
    size = F.size(words)
    windows = F.when(
        size >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), size - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    repeated = _let(
        windows,
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(
            F.lit(0).cast("long")
        ),
    )
    return F.struct(size.alias("n_words"), repeated.alias("n_repeat_words"))


def record(measured: DataFrame) -> DataFrame:
    """Add ``failures``, the mask of all rules, from the measurements."""
    bits = [
        F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in RULES
    ]
    return measured.withColumn("failures", reduce(lambda a, b: a.bitwiseOR(b), bits))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    return record(measure(docs, text))


def passes(policy: Policy) -> Column:
    return F.col("failures").bitwiseAND(F.lit(policy.mask)) == 0


def apply_policy(recorded: DataFrame, policy: Policy, column: str = "kept") -> DataFrame:
    """Add the policy's verdict; the ledger stays as it is."""
    return recorded.withColumn(column, passes(policy))


def ablation(recorded: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: documents that fail it, that fail it alone (and so would come
    back without it), and that the policy rejects. One narrow aggregate over the distinct masks."""
    masks = recorded.groupBy(
        F.col("failures").bitwiseAND(F.lit(policy.mask)).alias("mask")
    ).agg(F.count("*").alias("n"))
    chosen = [r for r in RULES if r.name in policy.rules]
    rule = F.explode(
        F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
                  for r in chosen])
    )
    pairs = masks.select("mask", "n", rule.alias("r")).select("mask", "n", "r.*")
    hit = F.col("mask").bitwiseAND(F.col("bit")) != 0
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    return pairs.groupBy("rule").agg(
        total(hit).alias("n_failed"),
        total(F.col("mask") == F.col("bit")).alias("n_only"),
        total(F.col("mask") != 0).alias("n_rejected"),
    )
