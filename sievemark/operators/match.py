"""Matching a dictionary of goods and services against sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import let, starts
from ..functions.text import alias_pattern, ascii_words, cookie_boilerplate, markdown_text, sentences
from .dataset import numbered

# Fixed values.
PREPOSITIONS = ("to", "for", "of", "in", "on", "at", "by", "from", "with", "without", "into", "onto", "under", "over", "within", "between", "among", "around", "through", "during", "after", "before")


def _shorten(c: Column) -> Column:
    t = F.regexp_replace(F.regexp_replace(c, "[“”]", '"'), "[‘’]", "'")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[*†‡•]+", ""), r"\s+", " "))


def aliases(taxonomy: DataFrame, text: str = "label") -> DataFrame:
    """``taxonomy`` with ``aliases`` (array) and ``note``; rows without an alias go.

    ``a / b`` are variants. A bracket at the end is a note (none, if the text before has two words and the bracket a
    preposition); one with text after it makes another alias with that text. One comma starts a note; of three pieces the last goes with
    the first, with the second and with both; more pieces are one alias.
    """
    variants = F.filter(F.transform(F.split(_shorten(F.col(text)), "/"), lambda v: F.trim(v)), lambda v: v != "")
    bracket = r"\[([^\]]*)\]"
    norm = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))

    def parse(v: Column) -> Column:
        content = F.trim(F.regexp_extract(v, bracket, 1))
        before, after = F.trim(F.regexp_extract(v, r"^([^\[]*)\[", 1)), F.trim(F.regexp_extract(v, r"\[[^\]]*\](.*)$", 1))
        plain = F.when(v.rlike(bracket), norm(F.concat(before, F.lit(" "), after))).otherwise(v)
        loose = (F.size(ascii_words(before)) >= 2) & F.arrays_overlap(ascii_words(content), F.array(*map(F.lit, PREPOSITIONS)))
        parts = F.filter(F.transform(F.split(plain, ","), lambda p: F.trim(p)), lambda p: p != "")
        n = F.size(parts)
        at = lambda k: F.get(parts, F.lit(k))
        made = (
            F.when(n <= 1, F.array(plain))
            .when(n == 2, F.array(at(0)))
            .when(n == 3, F.array(F.concat_ws(" ", at(0), at(2)), F.concat_ws(" ", at(1), at(2)), F.concat_ws(" ", at(0), at(1), at(2))))
            .otherwise(F.array(F.array_join(parts, " ")))
        )
        more = F.when((content != "") & (after != ""), F.array(norm(F.concat(content, F.lit(" "), after)))).otherwise(F.array().cast("array<string>"))
        notes = F.array_compact(F.array(F.when((content != "") & (after == "") & ~loose, content), F.when(n == 2, at(1))))
        return F.struct(F.concat(made, more).alias("aliases"), notes.alias("notes"))

    parsed = F.transform(variants, parse)
    every = F.filter(F.flatten(F.transform(parsed, lambda p: p["aliases"])), lambda a: a != "")
    rows = taxonomy.withColumn("_all", every).withColumn("_low", F.transform("_all", lambda a: F.lower(a)))
    kept = F.filter("_all", lambda a, i: F.array_position("_low", F.lower(a)) == i + 1)
    return rows.withColumn("aliases", kept).withColumn("note", F.array_join(F.flatten(F.transform(parsed, lambda p: p["notes"])), " | ")).where(F.size("aliases") > 0).drop("_all", "_low")


def number_sentences(pages: DataFrame, firm: str, page: str, text: str) -> DataFrame:
    """firm, sentence_id, page, sentence, is_cookie: sentences of each firm's pages, numbered from 1 by page, then position."""
    rows = pages.select(firm, page, F.posexplode(sentences(markdown_text(F.col(text)))).alias("_pos", "sentence"))
    rows = numbered(rows, [page, "_pos"], "sentence_id", [firm])
    return rows.select(firm, F.col("sentence_id").cast("int").alias("sentence_id"), page, "sentence", cookie_boilerplate(F.col("sentence")).alias("is_cookie"))


def match(sents: DataFrame, tokens: DataFrame, keys: list[str], text: str = "sentence") -> DataFrame:
    """keys, token_id, matched_alias, n of the best alias of each token in each sentence.

    tokens: token_id, aliases. Words of a sentence meet aliases by first word in an equi-join, the alias's pattern verifies, and
    the longest alias wins, then the first in order.
    """
    index = tokens.select("token_id", F.explode("aliases").alias("alias"))
    index = index.select("token_id", "alias", F.array_join(ascii_words(F.col("alias")), " ").alias("norm"), alias_pattern(F.col("alias")).alias("pattern")).where("norm <> ''")
    index = index.withColumn("word", F.split("norm", " ")[0])
    # only words that begin an alias leave their sentence; the sentence itself meets the aliases found in it once, by its keys
    words = sents.select(*keys, F.explode(F.array_distinct(ascii_words(F.col(text)))).alias("word")).join(index, "word")
    found = sents.select(*keys, text).join(words.drop("word"), keys).withColumn("n", F.regexp_count(F.col(text), F.col("pattern"))).where("n > 0")
    best = found.groupBy(*keys, "token_id").agg(F.min(F.struct((-F.length("norm")).alias("k"), "norm", "alias", "n")).alias("b"))
    return best.select(*keys, "token_id", F.col("b.alias").alias("matched_alias"), F.col("b.n").cast("long").alias("n"))


def spans(text: Column, pattern: Column) -> Column:
    """Array of (start, end) of a pattern's matches: the lengths of pieces and matches add up to them, in time that is linear in the matches."""
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    pairs = F.filter(F.arrays_zip(F.transform(parts, F.length).alias("p"), F.transform(found, F.length).alias("m")), lambda x: x["m"].isNotNull())

    def placed(steps: Column) -> Column:
        at = starts(F.transform(steps, lambda x: x["p"] + x["m"]))
        return F.zip_with(steps, at, lambda x, a: F.struct((a + x["p"]).cast("int").alias("start"), (a + x["p"] + x["m"]).cast("int").alias("end")))

    return let(pairs, placed)


def span_text(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), "|")


def sentence_stats(sents: DataFrame, firm: str) -> DataFrame:
    """By firm: sentences, mean and median words."""
    words = F.size(ascii_words(F.col("sentence")))
    return sents.withColumn("_w", words).groupBy(firm).agg(F.count("*").alias("n"), F.round(F.avg("_w"), 6).alias("mean_words"), F.round(F.percentile("_w", F.lit(0.5)), 6).alias("median_words"))


# Columns of the published list of goods and services.
TAXONOMY = {"Basic No. or Place / № de base ou endroit": "token_id", "Cl.": "cl", "X": "x", "Prop. No./№": "prop_no", "Action EN": "action_en", "EN - Goods and Services NCL (12-2024)": "label"}
HEADING = "Class Heading and Explanatory Note"


def taxonomy_rows(table: DataFrame, order: str) -> DataFrame:
    """token_id, cl, x, prop_no, action_en, label of the list as published.

    The first row by ``order`` explains the columns and goes, as do headings and rows without a number or a text. A missing column raises.
    """
    if missing := [c for c in TAXONOMY if c not in table.columns]:
        raise ValueError(f"columns {missing} not in {table.columns}")
    first = table.agg(F.min(order).alias("_first"))
    rows = table.crossJoin(F.broadcast(first)).where(F.col(order) > F.col("_first"))  # one row, so no product
    rows = rows.select(*(F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")).alias(n) for c, n in TAXONOMY.items()))
    return rows.where((F.col("token_id") != "") & (F.col("token_id") != HEADING) & (F.col("label") != ""))
