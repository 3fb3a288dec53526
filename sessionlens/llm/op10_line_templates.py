"""Line dedup by a tree of line templates.

A line's tokens are its parts between spaces; a token with a digit is a
variable field. The tree has a fixed depth: the number of tokens, then the
first ``LEAD`` tokens (variable fields as ``<*>``) lead to a leaf. A token stays
in the template if, at its place, it occurs in at least ``TEXTS`` different
texts of the leaf; any other token varies and becomes ``<*>``. Lines with the
same template are one class. A template recurs if at least ``TEXTS`` different
texts have it, at least ``FIXED`` of its tokens without digits are fixed, and at
least ``LEAST_FIXED`` of them. Lines of recurring templates are dropped, except
the first one (by doc_id, text hash and place), so no content leaves the corpus
altogether.

Besides, equal lines recur without a template: one of over ``LONG`` words that
stands in ``LONG_TEXTS`` different texts, and one of fewer than ``TOKENS``
tokens, which no template takes, that stands in ``SHORT_TEXTS``. Of these, too,
all but the first are dropped. Blank lines are left alone.

Texts, not rows, are counted: a text that was copied a thousand times is one
text, so copies alone make nothing recur.

Only DataFrame functions. Texts are cut into lines once, which are written with
the hashes of their leaf and of themselves; all later steps read what they need
of that table. Lines are first reduced to (leaf, masked line, text) and counted
with map-side aggregation; only lines of recurring leaves, each distinct one
once, are taken apart into tokens. The lines to drop come back as
a list of places for each document (a document's own lines at most).

Defined results: null text stays null and empty text empty; a text that loses
all lines becomes empty; rows that agree in doc_id and text lose the same
lines; ties cannot occur in the order of first lines but between such rows,
which keep the line together; all columns of the input pass through, and
``n_chars``, if there, is set to the new length where the text changed; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.llm.common import counted, keyed, stored, table, whole_rows

LEAD = 3
TOKENS = 5
TEXTS = 10
LONG = 50  # a line of more words recurs when it is equal in LONG_TEXTS texts
LONG_TEXTS = 2
SHORT_TEXTS = 30  # for lines of fewer than TOKENS tokens
FIXED = 0.7
LEAST_FIXED = 3
ANY = "<*>"


def spaced(text: Column) -> Column:
    """The text with white space but line ends as spaces."""
    for c in "\t\r\f\u000b":  # byte by byte, where translate works on characters
        # Looking for a byte is several times cheaper than replacing none.
        text = F.when(F.contains(text, F.lit(c)), F.replace(text, F.lit(c), F.lit(" "))).otherwise(text)
    return text


# From where the last match ended: whole tokens without a digit, kept; then one
# with a digit. Each character is looked at once.
FIELD = r"\G((?:[^ 0123456789]*[ ])*+)[^ 0123456789]*[0123456789][^ ]*"


def masked(line: Column) -> Column:
    """A line's tokens with a digit as variable fields."""
    return F.when(line.rlike("[0123456789]"), F.regexp_replace(line, FIELD, f"$1{ANY}")).otherwise(line)


def _tokens(line: Column) -> Column:
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def text_lines(docs: DataFrame) -> DataFrame:
    """(kid, print, place, tokens, line, mask) of every line that is not blank,
    trimmed; ``mask``, the masked line, only of lines that a template can take."""
    # Rows that agree in kid and print need no removal: texts are counted, and
    # the places to drop are sets.
    rows = keyed(docs).select("kid", "print", spaced(F.col("body")).alias("body"))
    lines = rows.select("kid", "print", F.posexplode(F.split("body", "\n")).alias("place", "line"))
    lines = lines.select("kid", "print", "place", F.trim("line").alias("line")).where(F.col("line") != "")
    lines = lines.select("kid", "print", "place", "line", _tokens(F.col("line")).alias("tokens"))
    return lines.select("*", F.when(F.col("tokens") >= TOKENS, masked(F.col("line"))).alias("mask"))


def prepared(docs: DataFrame) -> DataFrame:
    """The lines of ``docs`` as both kinds of recurrence read them, taken apart
    once: kid, print and place; leaf, own and line (masked) where a template can
    take the line, else null; class where the line may recur as it is, else
    null, and long."""
    line, tokens, mask = F.col("line"), F.col("tokens"), F.col("mask")
    # Tokens count runs of spaces, too; only the words of a long line do not.
    long = (tokens > LONG) & (~F.contains(line, F.lit("  ")) | (F.size(F.array_remove(F.split(line, " "), "")) > LONG))
    leaf = F.xxhash64(tokens, F.substring_index(mask, " ", LEAD))
    return text_lines(docs).select(
        "kid", "print", "place",
        F.when(mask.isNotNull(), leaf).alias("leaf"), F.when(mask.isNotNull(), F.xxhash64(mask)).alias("own"), mask.alias("line"),
        F.when((tokens < TOKENS) | long, F.xxhash64(line)).alias("class"), (tokens > LONG).alias("long"),
    )


def template_lines(lines: DataFrame, texts: int = TEXTS) -> DataFrame:
    """(kid, print, place) of every line of a recurring template but its first,
    from the stored ``prepared`` lines."""
    lines = lines.where(F.col("leaf").isNotNull()).select("kid", "print", "place", "leaf", "own", "line")
    seen = lines.select("leaf", "own", "print").distinct()
    support = stored(seen.groupBy("leaf", "own").agg(F.count("*").alias("texts")), "lines-support")
    # At least as many as the leaf's different texts; ``_in_texts`` counts these.
    leaves = stored(support.groupBy("leaf").agg(F.sum("texts").alias("texts")).where(F.col("texts") >= texts).select("leaf"), "lines-leaves")
    recurring = stored(lines.join(counted(leaves), "leaf"), "lines-recurring")
    distinct = stored(recurring.groupBy("leaf", "own").agg(F.min("line").alias("line")).join(support, ["leaf", "own"]), "lines-distinct")
    reach = recurring.select("leaf", "own", "print").distinct()
    token = distinct.select("leaf", "own", "texts", F.posexplode(F.split("line", " ")).alias("at", "token"))
    fixed = _in_texts(token.where(F.col("token") != ANY), ["leaf", "at", "token"], reach, texts, "lines-fixed")
    kept = token.join(counted(fixed), ["leaf", "at", "token"], "left_semi").select("leaf", "own", "at", "token")
    template = kept.groupBy("leaf", "own").agg(F.sort_array(F.collect_list(F.struct("at", "token"))).alias("template"))
    classes = (
        template.join(distinct.select("leaf", "own", "texts", F.size(F.array_remove(F.split("line", " "), ANY)).alias("words")), ["leaf", "own"])
        .where(F.size("template") >= F.greatest(F.lit(FIXED) * F.col("words"), F.lit(LEAST_FIXED)))
        .select("leaf", "own", "texts", F.xxhash64("leaf", "template").alias("class"))
    )
    classes = stored(classes, "lines-classes")
    common = _in_texts(classes, ["class"], reach, texts, "lines-common")
    chosen = stored(classes.join(counted(common), "class").select("leaf", "own", "class"), "lines-chosen")
    found = recurring.select("leaf", "own", "kid", "print", "place").join(counted(chosen), ["leaf", "own"])
    return _but_first(stored(found.select("class", "kid", "print", "place"), "lines-found"), "lines-first")


def _in_texts(lines: DataFrame, keys: list[str], reach: DataFrame, texts: int, name: str) -> DataFrame:
    """The keys whose lines stand in at least ``texts`` different texts.
    ``lines`` are distinct ones (leaf, own, texts and the keys), ``reach``
    their texts (leaf, own, print)."""
    met = lines.groupBy(*keys).agg(F.sum("texts").alias("met"), F.max("texts").alias("most"))
    met = stored(met.where(F.col("met") >= texts), f"{name}-met")
    # One line in enough texts decides; else the lines may share their texts,
    # which are put together (fewer than ``texts`` of each line).
    open_ = stored(met.where(F.col("most") < texts).select(*keys), f"{name}-open")
    each = lines.where(F.col("texts") < texts).join(counted(open_), keys).select("leaf", "own", *[F.col(k).alias(f"key_{k}") for k in keys])
    pairs = each.join(reach, ["leaf", "own"]).select("print", *[F.col(f"key_{k}").alias(k) for k in keys]).distinct()
    enough = pairs.groupBy(*keys).agg(F.count("*").alias("met")).where(F.col("met") >= texts)
    return stored(met.where(F.col("most") >= texts).select(*keys).unionByName(enough.select(*keys)), name)


def _but_first(found: DataFrame, name: str) -> DataFrame:
    """(kid, print, place) of every line of a class but its first."""
    first = found.groupBy("class").agg(F.min(F.struct("kid", "print", "place")).alias("first"))
    return found.join(counted(stored(first, name)), "class").where(F.struct("kid", "print", "place") != F.col("first")).select("kid", "print", "place")


def equal_lines(lines: DataFrame) -> DataFrame:
    """(kid, print, place) of every line but the first of the long and the
    short lines that recur as they are, from the stored ``prepared`` lines."""
    lines = lines.where(F.col("class").isNotNull()).select("kid", "print", "place", "class", "long")
    met = lines.select("class", "long", "print").distinct().groupBy("class", "long").agg(F.count("*").alias("texts"))
    chosen = stored(met.where(F.col("texts") >= F.when(F.col("long"), LONG_TEXTS).otherwise(SHORT_TEXTS)).select("class"), "lines-equal-chosen")
    found = stored(lines.drop("long").join(counted(chosen), "class"), "lines-equal-found")
    return _but_first(found, "lines-equal-first")


def drop_lines(docs: DataFrame, texts: int = TEXTS) -> DataFrame:
    """The rows and columns of ``docs`` with the lines of recurring templates
    and recurring equal lines dropped from ``text``, and ``lines_dropped``."""
    lines = stored(prepared(docs), "lines")
    out = template_lines(lines, texts).unionByName(equal_lines(lines)).groupBy("kid", "print").agg(F.collect_set("place").alias("places"))
    out = counted(stored(out, "lines-dropped"))
    rows = whole_rows(docs).join(out, ["kid", "print"], "left")
    left = F.filter(F.split(F.col("row.text"), "\n"), lambda line, i: ~F.array_contains("places", i))
    new = F.when(F.col("places").isNotNull(), F.array_join(left, "\n")).otherwise(F.col("row.text"))
    rows = rows.select("row", new.alias("new"), F.coalesce(F.size("places"), F.lit(0)).alias("dropped"))
    dropped = F.when(F.col("dropped") < 0, 0).otherwise(F.col("dropped")).cast("long")
    columns = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == "text":
            value = F.col("new")
        elif c == "n_chars":
            value = F.when(dropped > 0, F.length("new").cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    name = "lines_dropped"
    while name in docs.columns:
        name += "_"
    return rows.select(*columns, dropped.alias(name))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


# Counts are of different texts throughout: a leaf's, a fixed token's at its
# place, a template's, an equal line's.
ORACLE_SQL = f"""
with rows as (select row_number() over () as r, doc_id, text from documents),
bodies as (
  select r, coalesce(doc_id, -9223372036854775808) as kid, coalesce(text, '') as body,
         translate(coalesce(text, ''), chr(9) || chr(13) || chr(12) || chr(11), '    ') as plain from rows),
one as (select distinct kid, body, plain, regexp_replace(plain, '[^ \\n]*[0-9][^ \\n]*', '{ANY}', 'g') as mask from bodies),
cut as (select kid, body, unnest(string_split(mask, chr(10))) as raw, generate_subscripts(string_split(mask, chr(10)), 1) as place from one),
lines as (
  select kid, body, place, trim(raw, ' ') as line, string_split(trim(raw, ' '), ' ') as tokens from cut
  where len(string_split(trim(raw, ' '), ' ')) >= {TOKENS}),
met as (
  select line, body, any_value(tokens) as tokens, any_value(len(tokens) || chr(10) || array_to_string(tokens[1:{LEAD}], ' ')) as leaf
  from lines group by line, body),
leaves as (select leaf from met group by leaf having count(distinct body) >= {TEXTS}),
near as (select * from met semi join leaves using (leaf)),
token as (select leaf, line, body, unnest(tokens) as token, generate_subscripts(tokens, 1) as spot from near),
fixed as (select leaf, spot, token from token where token <> '{ANY}' group by leaf, spot, token having count(distinct body) >= {TEXTS}),
templates as (
  select leaf, line, list(spot || ' ' || token order by spot) as template
  from (select distinct leaf, line, spot, token from token semi join fixed using (leaf, spot, token)) group by leaf, line),
classes as (
  select t.leaf, t.line, t.template from templates t join (select line, any_value(tokens) as tokens from near group by line) d using (line)
  where len(t.template) >= greatest({FIXED} * len(list_filter(d.tokens, lambda x: x <> '{ANY}')), {LEAST_FIXED})),
common as (
  select c.leaf, c.template from classes c join near n using (leaf, line) group by c.leaf, c.template having count(distinct n.body) >= {TEXTS}),
framed as (
  select c.leaf || chr(10) || array_to_string(c.template, chr(10)) as class, l.kid, l.body, l.place
  from classes c semi join common using (leaf, template) join lines l using (line)),
whole as (
  select kid, body, unnest(string_split(plain, chr(10))) as raw, generate_subscripts(string_split(plain, chr(10)), 1) as place from one),
equals as (
  select kid, body, place, trim(raw, ' ') as line, len(list_filter(string_split(trim(raw, ' '), ' '), lambda x: x <> '')) > {LONG} as long
  from whole
  where trim(raw, ' ') <> '' and (len(string_split(trim(raw, ' '), ' ')) < {TOKENS}
     or len(list_filter(string_split(trim(raw, ' '), ' '), lambda x: x <> '')) > {LONG})),
again as (
  select line from equals group by line
  having count(distinct body) >= case when any_value(long) then {LONG_TEXTS} else {SHORT_TEXTS} end),
found as (
  select 't' || class as class, kid, body, place from framed
  union all select 'e' || line, kid, body, place from equals semi join again using (line)),
ranked as (select *, min(kid) over (partition by class) as lead_kid from found),
firsts as (select class, kid, body, min(place) as place from ranked where kid = lead_kid group by class, kid, body),
drops as (select kid, body, place from found anti join firsts using (class, kid, body, place) group by kid, body, place),
lists as (select kid, body, list(place) as places from drops group by kid, body)
select doc_id, case when places is null then text else array_to_string(
         list_filter(string_split(b.body, chr(10)), lambda x, i: not list_contains(places, i)), chr(10)) end as text,
       coalesce(len(places), 0) as lines_dropped
from bodies b join rows using (r) left join lists l on l.kid = b.kid and l.body = b.body
"""
