"""Quality rules as a ledger of bits: every rule is evaluated once, policies and ablations are bit operations on it.

``ledger`` gives each text's measurements and a bit for each rule that it fails. A policy is a named, versioned set of
rules; ``verdicts`` applies it without reading a text again, and ``ablations`` tells from counts of the distinct bit
sets what each rule of a policy rejects, alone and together with others.

All of it is built-in column functions. Windows of words are compared by 64-bit hashes; texts without a window found
twice, nearly all, never sort theirs.

Cases: a null text has no words, and measures zero throughout, as an empty one; repeated rows each return a row; an
empty table gives an empty one; columns of the input are kept in ``ledger`` only where asked for.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

BLANKS = " \t\n\x0b\f\r"
BLANK_PATTERN = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals")


@dataclass(frozen=True)
class Rule:
    """``fails`` is a condition on the measurements; the rule's place in ``RULES`` is its bit."""

    name: str
    fails: str


#: New rules are added at the end, so that bits of stored ledgers keep their meaning.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "100 * n_symbols > 25 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("capitals", "100 * n_capitals > 50 * word_chars"),
)


@dataclass(frozen=True)
class Policy:
    """A version of which rules reject a text."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: 1 << i for i, r in enumerate(RULES)}
        return sum(bits[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
WEB = Policy("web", 1, ("few_words", "repeated_words", "symbols", "duplicate_lines", "short_words", "long_words", "capitals"))


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, "")).cast("long")


def _repeated_words() -> Column:
    """Words in windows found twice or more: the windows' (hash, place) sorted, the places that have an equal
    neighbour in order, and for each of these the words up to the next."""
    same = lambda a, b: a["h"] == b["h"]
    pairs = F.col("_pairs")
    twice = F.transform(pairs, lambda p, i: F.when(same(p, F.get(pairs, i - 1)) | same(p, F.get(pairs, i + 1)), p["i"]))
    places = F.array_sort(F.filter(twice, lambda p: p.isNotNull()))
    step = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    add = lambda s, p: F.struct(
        (s["n"] + F.least(F.lit(WINDOW), p - s["last"])).alias("n"), p.alias("last")
    )
    return F.aggregate(places, step, add, lambda s: s["n"])


def measured(docs: DataFrame, text_col: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns and the measurements of each text."""
    rows = docs.select(F.struct(*carry).alias("_row"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.withColumn("_words", F.array_remove(F.split("_text", BLANK_PATTERN), ""))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    rows = rows.withColumn("_lines", lines)
    words = F.col("_words")
    window = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    none = F.array().cast("array<bigint>")
    hashes = F.when(F.size(words) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), window)).otherwise(none)
    rows = rows.select(
        "_row",
        F.size(words).cast("long").alias("n_words"),
        _without(F.col("_text"), BLANKS).alias("word_chars"),
        (F.length("_text") - _without(F.col("_text"), SYMBOLS)).alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        (F.length("_text") - _without(F.col("_text"), CAPITALS)).alias("n_capitals"),
        hashes.alias("_hashes"),
    )
    # Texts whose windows all differ have nothing to sort.
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    pairs = F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_pairs", F.when(repeats, pairs))
    rows = rows.withColumn("n_repeat_words", F.coalesce(_repeated_words(), F.lit(0).cast("long")))
    # Through an array of one: a filter on the measurements would otherwise be put below them and repeat them all.
    once = F.inline(F.array(F.struct("_row", *MEASURES)))
    return rows.select(once).select("_row.*", *MEASURES)


def failures() -> Column:
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(RULES)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out.cast("long")


def ledger(docs: DataFrame, text_col: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns, the measurements and ``failures``, a bit for each failed rule."""
    return measured(docs, text_col, carry).withColumn("failures", failures())


def fails(policy: Policy, bits: Column | None = None) -> Column:
    """Whether the ledger's bits break the policy."""
    return (F.col("failures") if bits is None else bits).bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def verdicts(rows: DataFrame, policies: Sequence[Policy]) -> DataFrame:
    """The ledger with a boolean column ``kept_<name>_v<version>`` for each policy."""
    return rows.select("*", *[(~fails(p)).alias(f"kept_{p.name}_v{p.version}") for p in policies])


def ablations(rows: DataFrame, policies: Sequence[Policy]) -> DataFrame:
    """(policy, version, rule, rejected, rejected_by_rule, only_by_rule, kept_without): for each rule of each policy.

    The ledger is counted by its distinct bit sets, at most 2 ** len(RULES); all else is arithmetic on these.
    """
    bits = [(p.name, p.version, p.mask, r.name, 1 << i) for p in policies for i, r in enumerate(RULES) if p.mask >> i & 1]
    names = ("policy", "version", "mask", "rule", "bit")
    sets = rows.groupBy("failures").agg(F.count("*").alias("n"))
    broken = F.col("failures").bitwiseAND(F.col("mask"))
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    pairs = sets.withColumn("a", F.explode(F.array(*[F.struct(*[F.lit(v).alias(c) for v, c in zip(b, names)]) for b in bits])))
    return pairs.select("failures", "n", "a.*").groupBy("policy", "version", "rule").agg(
        count(broken != 0).alias("rejected"),
        count(broken.bitwiseAND(F.col("bit")) != 0).alias("rejected_by_rule"),
        count(broken == F.col("bit")).alias("only_by_rule"),
        count((broken == 0) | (broken == F.col("bit"))).alias("kept_without"),
    )


def filtered(docs: DataFrame, policy: Policy = WEB, text_col: str = "text") -> DataFrame:
    """The rows whose text the policy keeps, with their own columns."""
    rows = docs.select(F.struct("*").alias("_own"), F.col(text_col).alias("_whole"))
    judged = ledger(rows, "_whole", ["_own"])
    return judged.where(~fails(policy)).select("_own.*")


def judged(rows: DataFrame, policy: Policy = WEB) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept``, the verdict of the base rules and the policy together."""
    return rows.select("*", fails(BASE).alias("base_failed"), (~(fails(BASE) | fails(policy))).alias("kept"))
