"""What an extraction model returns: JSON that is salvaged, normalised, deduplicated and checked against the page.

Payloads are read as VARIANT, so their many forms need no schema: lists of offerings under several keys, single objects, lists of objects, and text
that holds such JSON. All of it is column work on the row itself; only texts that do not parse reach Python.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.binding import let
from ..functions.text import main_content, text_list
from ..shared import table

NAME_MOST, DESCRIPTION_MOST, TAG_MOST, TAGS_MOST = 160, 520, 50, 10
# Fixed values.
LISTS = ("offerings", "items")
TYPED_LISTS = {"products": "product", "services": "service"}
WRAPPERS = ("extracted_content", "content", "data", "result", "output")
KNOWN_KEYS = ('"offerings"', '"items"', '"products"', '"services"', '"r"')
NAMES, DESCRIPTIONS, TYPES, TAGS = ("name", "title", "label"), ("description", "summary", "details"), ("type", "kind", "category"), ("tags", "keywords", "key_terms", "tag")
PRODUCT_WORDS = ("products", "product", "prod", "brand", "line", "goods")
SERVICE_WORDS = ("services", "service", "svc", "solutions", "solution", "capabilities", "capability")
SERVICE_HINTS = (
    "service", "solution", "capabilit", "consult", "managed", "support", "maintenance", "repair", "installation", "deployment", "integration", "migration", "logistics", "fulfillment",
    "training", "certification", "testing", "inspection", "manufactur", "contract manufacturing",
)
JUNK_TAGS = ("home", "about", "contact", "privacy", "terms", "cookie", "careers", "news", "blog", "sitemap")
JUNK_NAMES = ("home", "about", "contact", "privacy", "terms", "cookie", "cookies", "careers", "news", "blog", "sitemap", "login", "sign in", "signin", "register")
#: Stop words of at least four letters; shorter words are no evidence anyway.
STOPWORDS = ("with", "from", "into", "your", "their", "this", "that", "these", "those", "they")
PRESENCE_KEYS = ("r", "has_offering", "presence", "present", "classification", "result", "value")
CONFIDENCE_KEYS = ("confidence", "score", "prob", "p")
YES, NO = ("1", "true", "yes"), ("0", "false", "no")
#: JSON values that count as not given.
EMPTY = ("null", '""', "0", "0.0", "false", "[]", "{}")
_BLANK = r"[\s\x1C-\x1F\x85\p{Z}]+"


def clean(c: Column) -> Column:
    """Single spaces in place of white space of any script, none at the ends; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), _BLANK, " "))


def first_blob(text: str) -> str | None:
    """Of the JSON objects and lists in a text the first that names one of the known keys, else the first."""
    at, best = 0, None
    while (start := min((i for c in "{[" if (i := text.find(c, at)) >= 0), default=-1)) >= 0:
        try:
            end = json.JSONDecoder().raw_decode(text, start)[1]
        except (ValueError, RecursionError):
            at = start + 1
            continue
        blob, at = text[start:end], end
        if any(k in blob for k in KNOWN_KEYS):
            return blob
        best = best or blob
    return best


def _loaded(text: str) -> object:
    """The JSON of a text or of the first blob in it; None if it has none."""
    for candidate in (text.strip(), first_blob(text)):
        if candidate:
            try:
                return json.loads(candidate)
            except (ValueError, RecursionError):
                continue
    return None


def unwrapped_json(text: str, unwrap: bool = True) -> str | None:
    """JSON of an answer; with ``unwrap`` that in the first text under a wrapper key which holds JSON."""
    data = _loaded(text)
    if data is None:
        return None
    if unwrap and isinstance(data, dict):
        for key in WRAPPERS:
            if isinstance(data.get(key), str) and (inner := _loaded(data[key])) is not None:
                data = inner
                break
    return json.dumps(data, ensure_ascii=False)


def _parsed(text: Column) -> Column:
    """VARIANT of a text that is JSON as a whole. The parser stops after the first value, so texts that may go on after it have none."""
    goes_on = text.rlike(r"[}\]]\s*[^\s,\]}]") | ~text.rlike(r'(?s)^([{\[].*[}\]]|-?[0-9][0-9.eE+-]*|true|false|null|"[^"]*")\z')
    return F.when(~goes_on, F.try_parse_json(text))


def salvage(df: DataFrame, raw: str, unwrap: bool = True) -> DataFrame:
    """``df`` with ``json``: the text where it parses, else the JSON found in it, null if there is none.

    With ``unwrap``, an object with JSON as a text under ``content``, ``data``, ``result``, ``output`` or ``extracted_content`` stands for that JSON.
    Only texts that, or whose wrapped text, do not parse are sent to Python. JSON that names a key twice parses there alone.
    """

    @F.pandas_udf("string")
    def found(s: pd.Series) -> pd.Series:
        return s.map(lambda t: unwrapped_json(t, unwrap) if isinstance(t, str) else None)

    whole = F.trim(raw)
    marked = df.withColumn("_v", _parsed(whole))
    inner = F.lit(None).cast("string")
    if unwrap:
        inner = F.coalesce(*(F.when(F.schema_of_variant(F.try_variant_get("_v", f"$.{k}", "variant")) == "STRING", F.try_variant_get("_v", f"$.{k}", "string")) for k in WRAPPERS))
    marked = marked.withColumn("_inner", inner)
    read = F.when(F.col("_v").isNull(), None).when(F.col("_inner").isNull(), whole).when(_parsed(F.trim("_inner")).isNotNull(), F.trim("_inner"))
    marked = marked.withColumn("json", read).drop("_v", "_inner")
    return marked.withColumn("json", F.coalesce("json", found(F.when(F.col("json").isNull(), F.col(raw)))))


def _json(v: Column, key: str) -> Column:
    """JSON of a field; null if there is none."""
    return F.to_json(F.try_variant_get(v, f"$.{key}", "variant"))


def _text(v: Column) -> Column:
    """A value as text: texts as they are, numbers, True and False, nested values as JSON, nothing for null."""
    j = F.to_json(v)
    return F.when(j == "null", "").when(j == "true", "True").when(j == "false", "False").otherwise(F.coalesce(F.try_variant_get(v, "$", "string"), j))


def _given(v: Column, key: str) -> Column:
    return ~F.coalesce(_json(v, key), F.lit("null")).isin(*EMPTY)


def _first(v: Column, keys: tuple[str, ...]) -> Column:
    """The text of the first field that is given."""
    return clean(F.coalesce(*(F.when(_given(v, k), _text(F.try_variant_get(v, f"$.{k}", "variant"))) for k in keys)))


def _is(v: Column, kind: str) -> Column:
    return F.schema_of_variant(v).startswith(kind)


def _objects(v: Column, key: str) -> Column:
    """The list under a key; empty if there is none."""
    return F.coalesce(F.try_variant_get(v, f"$.{key}", "array<variant>"), F.array().cast("array<variant>"))


def _tags(v: Column) -> Column:
    """Texts under the first tag key that is given: a list, or a text that lists them with ``|``, ``;`` or ``,``. Not cut or cleaned."""

    def items(key: str) -> Column:
        one = F.try_variant_get(v, f"$.{key}", "variant")
        parts = let(clean(_text(one)), lambda t: F.split(t, F.when(F.contains(t, F.lit("|")), r"\|").when(F.contains(t, F.lit(";")), ";").otherwise(",")))
        return F.coalesce(F.transform(F.try_variant_get(v, f"$.{key}", "array<variant>"), _text), F.when(_is(one, "STRING"), parts), F.array(_text(one)))

    return F.coalesce(*(F.when(_given(v, k), items(k)) for k in TAGS), F.array().cast("array<string>"))


def _distinct_tags(items: Column) -> Column:
    """The first ten, whatever their case, each cut."""
    cut = F.transform(items, lambda t: F.rtrim(F.substring(clean(t), 1, TAG_MOST)))
    step = lambda acc, t: F.when((F.size(acc) >= TAGS_MOST) | (t == "") | F.exists(acc, lambda k: F.lower(k) == F.lower(t)), acc).otherwise(F.array_append(acc, t))
    return F.aggregate(cut, F.array().cast("array<string>"), step)


def _candidates(d: Column) -> Column:
    """Of an object: array of (v, kind, word), where ``kind`` is the type that a list implies and ``word`` a name that stands alone."""
    none, nothing = F.lit(None).cast("string"), F.lit(None).cast("variant")
    entry = lambda v, kind, word: F.struct(v.alias("v"), kind.alias("kind"), word.alias("word"))
    plain = [F.transform(F.filter(_objects(d, k), lambda v: _is(v, "OBJECT")), lambda v: entry(v, none, none)) for k in LISTS]

    def typed(key: str, kind: str) -> Column:
        known = F.filter(_objects(d, key), lambda v: _is(v, "OBJECT") | (F.schema_of_variant(v) == "STRING"))
        return F.transform(known, lambda v: entry(F.when(_is(v, "OBJECT"), v).otherwise(nothing), F.lit(kind), F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))))

    is_one = (_first(d, NAMES) != "") & ((_first(d, DESCRIPTIONS) != "") | (_first(d, TYPES) != "") | F.coalesce(_is(F.try_variant_get(d, "$.tags", "variant"), "ARRAY"), F.lit(False)))
    itself = F.when(is_one, F.array(entry(d, none, none))).otherwise(F.array().cast("array<struct<v:variant,kind:string,word:string>>"))
    return F.concat(*plain, *(typed(k, kind) for k, kind in TYPED_LISTS.items()), itself)


def _sanitized(c: Column) -> Column:
    """Struct (type, name, description, tags) of a candidate."""

    def read(c: Column) -> Column:
        v, alone = c["v"], c["word"].isNotNull()
        name = F.rtrim(F.substring(F.when(alone, clean(c["word"])).otherwise(_first(v, NAMES)), 1, NAME_MOST))
        description = F.rtrim(F.substring(F.when(alone, clean(c["word"])).otherwise(_first(v, DESCRIPTIONS)), 1, DESCRIPTION_MOST))
        implied = c["kind"].isNotNull() & (alone | _json(v, "type").isNull())
        kind = F.when(implied, c["kind"]).otherwise(F.lower(_first(v, TYPES)))
        return F.struct(kind.alias("kind"), name.alias("name"), description.alias("description"), F.when(alone, F.array().cast("array<string>")).otherwise(_distinct_tags(_tags(v))).alias("tags"))

    def typed(x: Column) -> Column:
        said = F.lower(F.concat_ws(" ", x["name"], x["description"], F.array_join(x["tags"], " ")))
        hinted = F.lit(False)
        for h in SERVICE_HINTS:
            hinted = hinted | F.contains(said, F.lit(h))
        kind = F.when(x["kind"].isin(*PRODUCT_WORDS), "product").when(x["kind"].isin(*SERVICE_WORDS), "service").when(hinted, "service").otherwise("product")
        whole = F.when(x["description"] == "", x["name"]).otherwise(x["description"])
        return F.struct(kind.alias("type"), x["name"].alias("name"), whole.alias("description"), F.filter(x["tags"], lambda t: ~F.lower(t).isin(*JUNK_TAGS)).alias("tags"))

    return let(read(c), typed)


def _one_each(items: Column) -> Column:
    """Of offerings with one type and lower-case name that with the longest description, then the most tags, then the first. The order stays.

    They are sorted and looked at once, so long lists cost no more an item than short ones.
    """
    ranked = F.transform(items, lambda o, i: F.struct(o["type"].alias("type"), F.lower(o["name"]).alias("low"), (-F.length(o["description"])).alias("length"), (-F.size(o["tags"])).alias("n"), i.alias("at"), o.alias("o")))

    def heads(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (s[F.greatest(i - 1, F.lit(0))]["type"] != x["type"]) | (s[F.greatest(i - 1, F.lit(0))]["low"] != x["low"]))

    kept = F.transform(let(F.array_sort(ranked), heads), lambda x: F.struct(x["at"].alias("at"), x["o"].alias("o")))
    return F.transform(F.array_sort(kept), lambda x: x["o"])


def offering_list(text: Column) -> Column:
    """Array of (type, name, description, tags) of the offerings in a JSON payload.

    They are looked for under ``offerings``, ``items``, ``products`` and ``services``, in the object itself, and in each object of a list. Fields have
    other names too; a type is read from words for it, else guessed from the text; an empty description is the name. Names are cut at 160 characters,
    descriptions at 520, ten tags at 50. Nothing without a name stays. Null and what is no JSON have none.
    """

    def found(v: Column) -> Column:
        objects = F.coalesce(F.filter(F.try_variant_get(v, "$", "array<variant>"), lambda x: _is(x, "OBJECT")), F.when(_is(v, "OBJECT"), F.array(v)), F.array().cast("array<variant>"))
        every = F.flatten(F.transform(objects, _candidates))
        return F.filter(F.transform(every, _sanitized), lambda o: o["name"] != "")

    return _one_each(let(F.try_parse_json(text), found))


def offerings(df: DataFrame, keys: list[str], json_col: str = "json") -> DataFrame:
    """keys, type, name, description, tags: ``offering_list`` as rows."""
    return df.select(*keys, F.explode(offering_list(F.col(json_col))).alias("o")).select(*keys, "o.*")


def merge_offerings(df: DataFrame, keys: list[str]) -> DataFrame:
    """Offerings of several answers with the same keys, such as a page's chunks, as one each. Longest description, then most tags, then first description."""
    order = Window.partitionBy(*keys, "type", F.lower("name")).orderBy(F.length("description").desc(), F.size("tags").desc(), "description", "name")
    return df.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def _keywords(c: Column) -> Column:
    """Words of ASCII letters and digits that can be evidence."""
    words = F.split(F.lower(F.trim(F.regexp_replace(clean(c), "[®™©]+", ""))), "[^a-z0-9]+")
    return F.filter(F.array_distinct(words), lambda w: (F.length(w) >= 4) & ~w.isin(*STOPWORDS))


def supported(items: Column, body: Column) -> Column:
    """The offerings of an array that a page supports.

    Junk names go. Then a tag is enough, or the name on the page (with or without trademark signs), a word of it, two words of the description, or a
    description of at least 40 characters that is neither junk nor the name. The page counts from its first top heading on; an empty page supports all.
    """

    def kept(page: Column) -> Column:
        def stays(o: Column) -> Column:
            name, low = clean(o["name"]), F.lower(clean(o["name"]))
            bare = F.lower(F.trim(F.regexp_replace(name, "[®™©]+", "")))
            seen = F.contains(page["text"], low) | ((bare != "") & F.contains(page["text"], bare)) | F.arrays_overlap(_keywords(name), page["words"]) | (F.size(F.array_intersect(_keywords(o["description"]), page["words"])) >= 2)
            own = F.lower(clean(o["description"]))
            own = (F.length(own) >= 40) & ~own.isin(*JUNK_NAMES) & (own != low)
            return ~low.isin(*JUNK_NAMES) & ((F.size(o["tags"]) > 0) | (page["text"] == "") | (low != "") & seen | own)

        return F.filter(items, stays)

    text = F.lower(main_content(F.coalesce(body, F.lit(""))))
    return let(F.struct(text.alias("text"), F.array_distinct(F.split(text, r"(?U)\W+")).alias("words")), kept)


def presence(json_text: Column, raw: Column) -> Column:
    """Struct (has, confidence) of an answer to a yes-or-no question: a scalar, an object under one of several keys, or a list whose first item counts.

    ``json_text`` is what ``salvage`` found in ``raw``, null if nothing; then ``raw`` counts as a word. Confidence is the first number between 0 and 1 under one of its keys; where ``r`` is a number, under the first of these keys that is there.
    """

    def scalar(v: Column) -> Column:
        s = F.lower(F.trim(F.coalesce(F.try_variant_get(v, "$", "string"), F.lit(""))))
        s = F.when((F.schema_of_variant(v) != "STRING") & s.isin("1.0", "0.0"), F.substring(s, 1, 1)).otherwise(s)
        return F.when(s.isin(*YES), True).when(s.isin(*NO), False)

    def read(v: Column) -> Column:
        field = lambda k: F.try_variant_get(v, f"$.{k}", "variant")
        number = lambda k: F.when(_json(v, k) == "true", 1.0).when(_json(v, k) == "false", 0.0).otherwise(F.try_variant_get(v, f"$.{k}", "string").try_cast("double"))
        fit = lambda k: F.when((number(k) >= 0) & (number(k) <= 1), number(k))
        there = F.coalesce(*(F.when(_json(v, k).isNotNull(), F.lit(k)) for k in CONFIDENCE_KEYS))
        strict = F.coalesce(*(F.when(there == k, fit(k)) for k in CONFIDENCE_KEYS))
        plain = F.coalesce(F.trim(F.try_variant_get(v, "$.r", "string")).isin("0", "1", "0.0", "1.0", "true", "false"), F.lit(False))
        keyed = F.coalesce(*(scalar(field(k)) for k in PRESENCE_KEYS))
        conf = F.when(_is(v, "OBJECT"), F.when(plain, strict).otherwise(F.coalesce(*(fit(k) for k in CONFIDENCE_KEYS))))
        return F.struct(F.coalesce(F.when(_is(v, "OBJECT"), keyed).otherwise(scalar(v)), F.lit(False)).alias("has"), conf.alias("confidence"))

    parsed = F.try_parse_json(json_text)
    top = let(parsed, lambda v: F.when(_is(v, "ARRAY"), F.get(F.try_variant_get(v, "$", "array<variant>"), F.lit(0))).otherwise(v))
    word = F.struct(F.coalesce(F.lower(F.trim(raw)).isin(*YES), F.lit(False)).alias("has"), F.lit(None).cast("double").alias("confidence"))
    return F.when(parsed.isNull(), word).otherwise(let(top, read))


def merge_presence(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Answers of a page's chunks as one: any yes, the greatest confidence, the last preview. chunks: keys, ix, has, confidence, preview."""
    return chunks.groupBy(*keys).agg(F.bool_or("has").alias("has"), F.max("confidence").alias("confidence"), F.max_by("preview", "ix").alias("preview"))


def presence_pass(pending: DataFrame, ask: Callable[[list[str]], list[str]]) -> DataFrame:
    """company_id, url, status, presence, confidence of pending pages (company_id, url, markdown_path, body); only pages with text reach the model."""
    blank = F.coalesce(F.trim("body"), F.lit("")) == ""
    skipped = pending.where(F.col("markdown_path").isNull() | (F.col("markdown_path") == "") | blank)
    why = F.when(F.coalesce("markdown_path", F.lit("")) == "", "llm_presence_skipped_no_markdown").otherwise("llm_presence_empty_markdown")
    skipped = skipped.select("company_id", "url", why.alias("status"), F.lit(0).alias("presence"), F.lit(None).cast("double").alias("confidence"))

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[["company_id", "url"]].assign(answer=ask(pdf["body"].tolist()))

    rows = pending.where((F.coalesce("markdown_path", F.lit("")) != "") & ~blank).select("company_id", "url", "body")
    types = dict(rows.dtypes)
    answers = table(rows.mapInPandas(part, f"company_id {types['company_id']}, url string, answer string"), "presence-answers")  # a model is asked once
    answers = salvage(answers, "answer", unwrap=False)
    asked = answers.withColumn("p", presence(F.col("json"), F.col("answer")))
    return skipped.unionByName(asked.select("company_id", "url", F.when(F.col("p.has"), "llm_presence_yes").otherwise("llm_presence_no").alias("status"), F.col("p.has").cast("int").alias("presence"), F.col("p.confidence").alias("confidence")))


def tag_list(c: Column) -> Column:
    return text_list(c, 10)
