"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Base figures are computed for every document and two base rules decide first. The other
rules form a cascade: a sample shows what each rule costs and how often it rejects, and
the rules run in the order of rejections per cost, each only on documents that all before
it let pass. The verdict is whether any rule rejects, so it does not depend on the order.

A null or empty text has no words and fails the base rules. Repeated rows are judged each.
Only doc_id and text are read.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.llm.base import native_words, smallest_hashes

WINDOW, LEAST_WORDS, REPEATED_PERCENT = 3, 50, 50
#: So many documents are what rules are measured on, copied up to so many bytes a run; runs of each.
SAMPLE_ROWS, TIMED_BYTES, RUNS = 400, 24 << 20, 3
SYMBOLS, SPACE_CHARS = "#*$%&|<>", " \t\n\x0b\x0c\r"


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once for the row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- base figures ---------------------------------------------------------

def repeated_words(words: Column) -> Column:
    """How many words lie in a window of WINDOW words that occurs at least twice.

    Windows are sorted by hash, so equal ones are neighbours: no pairs are compared.
    """
    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.struct(
            F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]).alias("hash"), i.alias("at")))

    def covered(s: Column) -> Column:
        def same(i, step):
            return F.coalesce(F.get(s, i + step)["hash"] == F.get(s, i)["hash"], F.lit(False))

        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: same(i, -1) | same(i, 1))
        places = F.flatten(F.transform(starts, lambda i: F.transform(
            F.array(*[F.lit(k) for k in range(WINDOW)]), lambda k: F.get(s, i)["at"] + k)))
        return F.size(F.array_distinct(places))

    return _let(words, lambda w: F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(
        _let(F.sort_array(windows(w)), covered))).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.when(
        F.length(F.translate(x, SPACE_CHARS, "")) > 0, F.struct(F.xxhash64(x), F.length(x)))), lambda x: x.isNotNull())
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def base_figures(docs: DataFrame) -> DataFrame:
    """doc_id and text with the base figures and `base_failed`."""
    text = F.coalesce("text", F.lit(""))
    words = native_words(text)
    figures = docs.select("doc_id", text.alias("text"), _let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"))).alias("counted"))
    figures = figures.select(
        "doc_id", "text", "counted.n_words", _chars("word_chars", F.col("text")),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("text")).alias("n_dup_lines"), "counted.n_repeat_words")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    return figures.withColumn("base_failed", failed)


def _chars(name: str, text: Column) -> Column:
    return F.length(F.translate(text, SPACE_CHARS, "")).cast("long").alias(name)


# --- rules ----------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """Rejects a document where the expression over its text and base figures is true."""

    name: str
    rejects: str


RULES = [
    Rule("short_or_long_words", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "n_dup_lines >= 5 and 2 * n_dup_lines > 1 + length(text) - length(replace(text, '\\n', ''))"),
    Rule("few_letters", "10 * length(regexp_replace(text, '[^\\\\p{L}]+', '')) < 6 * word_chars"),
    Rule("shouting", "2 * length(regexp_replace(text, '[^\\\\p{Lu}]+', '')) > word_chars"),
    Rule("digits", "5 * (length(text) - length(translate(text, '0123456789', ''))) > word_chars"),
    Rule("exclamations", "4 * (length(text) - length(translate(text, '!?', ''))) > n_words"),
    Rule("few_different_words",
         "size(array_distinct(transform(split(lower(text), '[\\\\x20\\\\x09-\\\\x0D]+'), w -> xxhash64(w)))) * 10 < n_words"),
]


def sample(docs: DataFrame) -> DataFrame:
    """A bounded sample of whole texts for measuring rules; it decides only their order."""
    return smallest_hashes(docs.select("doc_id", "text"), SAMPLE_ROWS, "doc_id", F.xxhash64("text"))


def measured(docs: DataFrame, rules: list[Rule]) -> tuple[list[float], list[tuple[bool, ...]]]:
    """The seconds a row that each rule costs, and for each row of the sample which rules reject it."""
    rows = base_figures(sample(docs)).filter("not base_failed").persist()
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length("text") + 1)).first()
    if not n:
        rows.unpersist()
        return [0.0] * len(rules), []
    times = max(1, TIMED_BYTES // size)
    copies = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times))))

    def seconds(rejects: str) -> float:
        found = []
        for _ in range(RUNS):
            start = time.perf_counter()
            copies.agg(F.count_if(F.expr(rejects))).first()
            found.append(time.perf_counter() - start)
        return min(found)

    empty = seconds("copy < 0 and text is null")
    costs = [max(0.0, seconds(f"copy > 0 and ({r.rejects})") - empty) / (n * times) for r in rules]
    found = rows.select(F.array(*[F.coalesce(F.expr(r.rejects), F.lit(False)) for r in rules]).alias("rejected")).collect()
    rows.unpersist()
    return costs, [tuple(r.rejected) for r in found]


def ordered(rules: list[Rule], costs: list[float], rejected: list[tuple[bool, ...]]) -> list[Rule]:
    """The rule with most rejections per cost first, then that among the rows it lets pass, and so on.

    Rules that reject nothing any more come last, the cheapest first.
    """
    left, rows, out = list(range(len(rules))), rejected, []
    while left:
        def gain(i: int) -> tuple:
            hits = sum(r[i] for r in rows)
            return -hits / max(costs[i], 1e-12), costs[i], rules[i].name

        best = min(left, key=gain)
        left.remove(best)
        rows = [r for r in rows if not r[best]]
        out.append(rules[best])
    return out


def passes(rules: list[Rule]) -> Column:
    """True if no rule rejects. A rule runs only where those before it did not reject."""
    verdict = F.when(F.col("base_failed"), False)
    for rule in rules:
        verdict = verdict.when(F.expr(rule.rejects), False)
    return verdict.otherwise(True)


def judged(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Per document its base figures, `base_failed` and `kept`."""
    rules = RULES if rules is None else rules
    rules = ordered(rules, *measured(docs, rules))
    return base_figures(docs).withColumn("kept", passes(rules)).drop("text")


_RULES_SQL = " or ".join(f"({x})" for x in (
    "word_chars < 2 * n_words or word_chars > 20 * n_words",
    "10 * n_symbols > n_words",
    "n_dup_lines >= 5 and 2 * n_dup_lines > 1 + length(text) - length(replace(text, chr(10), ''))",
    "10 * length(regexp_replace(text, '[^\\p{L}]+', '', 'g')) < 6 * word_chars",
    "2 * length(regexp_replace(text, '[^\\p{Lu}]+', '', 'g')) > word_chars",
    "5 * (length(text) - length(regexp_replace(text, '[0-9]', '', 'g'))) > word_chars",
    "4 * (length(text) - length(regexp_replace(text, '[!?]', '', 'g'))) > n_words",
    "len(list_distinct(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'))) * 10 < n_words",
))
SQL = f"""with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents
), g as (
  select r, pos, words[pos:pos + 2] as win from (select r, words, unnest(range(1, len(words) - 1)) as pos from d)
), twice as (
  select r, pos from g qualify count(*) over (partition by r, win) > 1
), cover as (
  select r, count(distinct pos + k) as n from twice, (select unnest([0, 1, 2]) as k) group by r
), l as (
  select r, unnest(string_split(text, chr(10))) as line from d
), dup as (
  select r, count(*) - count(distinct line) as n from l where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by r
), f as (
  select d.doc_id, d.text, len(words)::bigint as n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    coalesce(dup.n, 0)::bigint as n_dup_lines, coalesce(cover.n, 0)::bigint as n_repeat_words
  from d left join cover using (r) left join dup using (r)
), b as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from f
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or {_RULES_SQL}) as kept
from b"""
