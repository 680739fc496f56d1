"""Operator 10, line dedup by a log-template tree.

A line goes down a tree of fixed depth: by its number of words, then by its first
``LEADING`` words. Words with a digit are variable fields from the start; in a line
of fields only they are taken as they stand, so it is only ever like its own copies.
The lines of a leaf form templates of three kinds:

* the line itself with its fields left open;
* the leaf's common form: a place is constant if one word holds it in at least
  ``AGREEMENT`` of the leaf's different lines, else it is a field. It is a template
  if at least ``AGREEMENT`` of the places after the leading words, and one at
  least, are constant, and some constant is a word; lines that have all its
  constants match it;
* a line with one run of places after the leading words open, as long as leaves
  ``AGREEMENT`` of these places, and a word constant. A leaf can have any number of these.

A line goes by the common form if it matches one that recurs, else by that of its recurring forms
with a run open that most documents hold (of several, the one whose first document comes first),
else by itself. A template that occurs in ``MIN_DOCS`` documents or more recurs. Its lines stay in
the first of those documents (the least ``doc_id``) and are dropped elsewhere.

Edge cases: a null text stays null, an empty one stays empty (no lines dropped); lines of
fewer than ``MIN_WORDS`` words are never templates, unless they have as many letters of a
script written without spaces (a whole sentence is one word there); rows alike in ``doc_id`` and text are
one document and fare alike; documents without ``doc_id`` come after all others;
a document may lose all its lines, its row stays; other columns are kept, whatever their names.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postclust.llm.common import keep_listed, materialize, salted_lookup

LEADING = 3
MIN_WORDS = 3
MIN_DOCS = 3
AGREEMENT = 0.7

FIELD = "<*>"

#: Letters of scripts that are written without spaces between words.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"

DOC = ["_id", "_text_hash"]


def keyed_id() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"))


def keyed(docs: DataFrame) -> DataFrame:
    """Documents by ``_id`` (null last) and a hash of the text."""
    return docs.select(keyed_id().alias("_id"), F.xxhash64("text").alias("_text_hash"), "text")


def lines_of(rows: DataFrame) -> DataFrame:
    """Each line with its words (fields open, unless no word were left) and its leaf in the tree."""
    # words are made inside the generator, else each later use of them repeats the patterns
    said = F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("line"), words_of(opened(line)).alias("words")))
    return leaves_of(rows.select(*DOC, F.posexplode(said).alias("line_no", "said")).select(*DOC, "line_no", "said.*"))


def leaves_of(line: DataFrame) -> DataFrame:
    enough = (F.size("words") >= MIN_WORDS) | (F.regexp_count("line", F.lit(UNSPACED)) >= MIN_WORDS)
    line = line.where(enough).withColumn("bare", F.expr(f"words[0] = '{FIELD}' and forall(words, w -> w = '{FIELD}')"))
    line = line.withColumn("words", F.when(F.col("bare"), words_of(F.col("line"))).otherwise(F.col("words")))
    # a line without constants has a leaf of its own, so no other form can take it in
    branch = F.when(F.col("bare"), F.col("words")).otherwise(F.slice("words", 1, LEADING))
    return line.select(*DOC, "line_no", F.xxhash64(F.size("words"), branch).alias("leaf"), "words")


def opened(line: Column) -> Column:
    return F.when(F.rlike(line, F.lit("[0-9]")), F.regexp_replace(line, r"(?<!\S)[^\s0-9]*+[0-9]\S*", FIELD)).otherwise(line)


def words_of(line: Column) -> Column:
    # most lines have no white space but single spaces
    plain = F.when(F.rlike(line, F.lit(r"[\s&&[^ ]]|  ")), F.regexp_replace(line, r"\s+", " ")).otherwise(line)
    return F.split(F.trim(plain), " ")


def parsed(rows: DataFrame) -> DataFrame:
    """``(document, line_no, leaf, form)``: hashes of a line's leaf and of its words."""
    return lines_of(rows).select(*DOC, "line_no", "leaf", F.xxhash64("words").alias("form"), F.size("words").alias("n"))


def doc_key() -> Column:
    return F.struct(*DOC)


def recurring(seen: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur in ``MIN_DOCS`` documents, with the first; ``seen`` has a
    row for each key and document."""
    return seen.groupBy(*keys).agg(F.count("*").alias("docs"), F.min(doc_key()).alias("first")).where(F.col("docs") >= MIN_DOCS)


def different_lines(rows: DataFrame, lines: DataFrame, seen: DataFrame) -> DataFrame:
    """``(leaf, form, words)``: the different lines of the leaves that have several. One line
    stands for all with its words, and only for those lines are words made again."""
    per_leaf = seen.groupBy("leaf", *DOC).agg(F.min("form").alias("a"), F.max("form").alias("b"))
    leaves = per_leaf.groupBy("leaf").agg(F.count("*").alias("docs"), F.min("a").alias("a"), F.max("b").alias("b"))
    mixed = materialize(leaves.where((F.col("docs") >= MIN_DOCS) & (F.col("a") != F.col("b"))).select("leaf"), "leaves")
    one = keep_listed(lines, mixed, ["leaf"]).groupBy("leaf", "form").agg(F.min(F.struct(*DOC, "line_no")).alias("one"))
    standing = materialize(one.select("one.*").distinct(), "standing")
    said = rows.select(*DOC, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    # rows alike in id and text give a line several times
    said = keep_listed(said, standing, [*DOC, "line_no"]).groupBy(*DOC, "line_no").agg(F.first("line").alias("line"))
    made = said.select(*DOC, "line_no", F.inline(F.array(F.struct("line", words_of(opened(F.col("line"))).alias("words")))))
    different = leaves_of(made).select("leaf", F.xxhash64("words").alias("form"), "words")
    return materialize(different, "different")


def common_forms(different: DataFrame) -> DataFrame:
    """``(leaf, form)``: the lines that have all constants of their leaf's common form."""
    size = different.groupBy("leaf").agg(F.count("*").alias("lines"))
    said = different.select("leaf", F.posexplode("words").alias("at", "word")).groupBy("leaf", "at", "word").count()
    most = said.groupBy("leaf", "at").agg(F.max(F.struct("count", "word")).alias("most"))
    place = F.struct("at", F.when(F.col("most.count") >= AGREEMENT * F.col("lines"), F.col("most.word")).alias("word"))
    forms = most.join(size, "leaf").groupBy("leaf").agg(F.sort_array(F.collect_list(place)).alias("places"))
    constants = F.transform("places", lambda p: p["word"])
    after = F.expr(f"filter(slice(constants, {LEADING + 1}, greatest(size(constants) - {LEADING}, 0)), w -> w is not null)")
    enough = (F.size(after) >= 1) & (F.size(after) >= AGREEMENT * (F.size("constants") - LEADING))
    worded = F.expr(f"exists(constants, w -> w is not null and w <> '{FIELD}')")
    forms = materialize(forms.select("leaf", constants.alias("constants")).where(enough & worded), "forms")
    # which of the leaf's different lines have all the constants
    matches = F.expr("forall(arrays_zip(words, constants), p -> p.constants is null or p.constants = p.words)")
    matched = salted_lookup(different, "leaf", forms, ["form"], how="inner")
    return matched.where(matches).select("leaf", "form")


#: Bits of a word's share in a sum, so that a sum over a line stays within 64.
SHARE_BITS = 40


def run_forms(different: DataFrame, seen: DataFrame) -> DataFrame:
    """``(leaf, form, run_first)``: the lines that recur as forms with a run of places open, with
    the first document of the form that most documents hold."""
    after = F.size("words") - LEADING
    lines = different.withColumn("run", (after - F.ceil(AGREEMENT * after)).cast("int")).where("run >= 1")
    # a run leaves the first or the last third of the places whole: only lines that share one are opened
    third = F.floor(after / 3).cast("int")
    thirds = lines.select("leaf", "form", F.explode(F.array(
        F.xxhash64("leaf", F.lit(0), F.slice("words", LEADING + 1, third)),
        F.xxhash64("leaf", F.lit(1), F.slice("words", F.size("words") - third + 1, third)))).alias("third"))
    met = materialize(thirds.groupBy("third").count().where("count > 1").select("third"), "thirds")
    alike = materialize(keep_listed(thirds, met, ["third"]).select("leaf", "form").distinct(), "alike")
    near = materialize(keep_listed(lines, alike, ["leaf", "form"]), "near")

    # what stands outside a run is the sum over the line less the sum over the run: each word adds hashes
    # of itself and its place; sums up to a place are made once a line, so a line costs what its length is
    word = near.select("leaf", "form", "run", F.size("words").alias("size"), F.posexplode("words").alias("at", "word"))
    share = lambda k: F.xxhash64("word", "at", F.lit(k)).bitwiseAND(F.lit((1 << SHARE_BITS) - 1))
    sums = {"a": share(0), "b": share(1), "fixed": (F.col("word") != FIELD).cast("long")}
    line, upto = Window.partitionBy("leaf", "form"), Window.partitionBy("leaf", "form").orderBy("at")
    summed = word.select("leaf", "form", "run", "size", "at", *[F.sum(c).over(upto).alias(k) for k, c in sums.items()],
                         *[F.sum(c).over(line).alias(f"all_{k}") for k, c in sums.items()])
    # the sum up to a run's last place counts, that up to the place before it counts off
    ends = F.array(F.struct((F.col("at") - F.col("run") + 1).alias("start"), F.lit(1).alias("sign")),
                   F.struct((F.col("at") + 1).alias("start"), F.lit(-1).alias("sign")))
    parts = summed.select("*", F.inline(ends)).where(f"start >= {LEADING} and start <= size - run")
    outside = [(F.first(f"all_{k}") - F.sum(F.col("sign") * F.col(k))).alias(k) for k in sums]
    opened = parts.groupBy("leaf", "form", "start").agg(*outside).where("fixed > 0")
    opened = materialize(opened.select("leaf", "form", F.xxhash64("leaf", "start", "a", "b").alias("template")), "opened")
    several = materialize(opened.groupBy("template").count().where("count > 1").select("template"), "several")
    members = materialize(keep_listed(opened, several, ["template"]), "members")
    held = keep_listed(seen, members, ["leaf", "form"], "inner").select("template", *DOC).distinct()
    firsts = materialize(recurring(held, ["template"]), "firsts")
    found = salted_lookup(members, "template", firsts, ["form"], how="inner")
    return found.groupBy("leaf", "form").agg(F.min(F.struct((-F.col("docs")).alias("rank"), "first")).alias("most")).select(
        "leaf", "form", F.col("most.first").alias("run_first"))


def drop_recurring_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines of recurring templates taken out of ``text`` but in their
    first document, and ``n_lines`` and ``n_dropped`` (of columns so named, these are the new ones)."""
    rows = keyed(docs)
    lines = materialize(parsed(rows), "lines")
    seen = materialize(lines.select("leaf", "form", *DOC).distinct(), "seen")
    own = recurring(seen, ["leaf", "form"]).select("leaf", "form", F.col("first").alias("own_first"))

    different = different_lines(rows, lines, seen)
    common = materialize(common_forms(different), "common")
    in_common = seen.join(common, ["leaf", "form"], "left_semi")
    shared = recurring(in_common.select("leaf", *DOC).distinct(), ["leaf"])
    shared = common.join(shared, "leaf").select("leaf", "form", F.col("first").alias("common_first"))

    runs = materialize(run_forms(different, seen), "runs")
    template = own.join(shared, ["leaf", "form"], "full").join(runs, ["leaf", "form"], "full")
    template = materialize(template.select(
        F.struct("leaf", "form").alias("template"), "own_first", "run_first", "common_first"), "templates")
    marked = salted_lookup(lines.withColumn("template", F.struct("leaf", "form")), "template", template,
                           ["_text_hash", "line_no"], how="inner")
    later = F.coalesce(doc_key() != F.col("common_first"), doc_key() != F.col("run_first"), doc_key() != F.col("own_first"))
    dropped = marked.where(later).groupBy(*DOC).agg(F.collect_set("line_no").alias("_dropped"))

    # the row travels as one struct: no column of it can clash with the names used here
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), keyed_id().alias("_id"),
                        F.xxhash64("text").alias("_text_hash"))
    same = whole["_id"].eqNullSafe(dropped["_id"]) & (whole["_text_hash"] == dropped["_text_hash"])
    joined = whole.join(dropped, same, "left").select("_row", "_dropped")
    kept = F.expr("array_join(filter(split(_row.text, '\n'), (line, i) -> not array_contains(_dropped, i)), '\n')")
    taken = F.col("_dropped").isNotNull()
    out = {c: F.col("_row").getField(c) for c in docs.columns}
    text = out["text"]
    out["text"] = F.when(taken, kept).otherwise(text)
    out["n_lines"] = F.when(text.isNull() | (text == ""), 0).otherwise(F.size(F.split(text, "\n"))).cast("long")
    out["n_dropped"] = F.when(taken, F.size("_dropped")).otherwise(0).cast("long")
    return joined.select(*[c.alias(name) for name, c in out.items()])
