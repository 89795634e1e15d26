"""Legal labels, the hierarchy they form, and evidence for numbered paragraphs, as expressions and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.operators.sequences import nearest_parent

# Levels and their labels, Vietnamese and English; fixed values.
LEVELS = [("part", 10, "phần|part"), ("chapter", 20, "chương|chapter"), ("section", 30, "mục|section"), ("subsection", 40, "tiểu mục|subsection"), ("article", 50, "điều|article"), ("clause", 60, "khoản|clause"), ("point", 70, "điểm|point")]
# Words after a label that make it a citation; fixed values.
CITING = "của|tại|và|hoặc|đến|theo|này|nêu|quy định|of|and|or|to|in|under|this|that"
ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "abcdđeghiklmnopqrstuvxy")  # Latin, and Vietnamese without marks


def roman(c: Column) -> Column:
    """Value of a Roman numeral from 1 to 3999 in its canonical form, else null."""
    values = F.create_map(*[F.lit(x) for kv in {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}.items() for x in kv])
    upper = F.upper(c)
    ok = upper.rlike("^M{0,3}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$") & (c != "")
    numbers = F.transform(F.split(upper, ""), lambda x: values[x])
    nexts = F.concat(F.slice(numbers, 2, F.greatest(F.size(numbers) - 1, F.lit(0))), F.array(F.lit(0)))
    return F.when(ok, F.aggregate(F.zip_with(numbers, nexts, lambda a, b: F.when(a < b, -a).otherwise(a)), F.lit(0), lambda s, x: s + x))


def successor(letter: Column, nxt: Column) -> Column:
    """Whether ``nxt`` follows ``letter`` in either alphabet."""
    hit = F.lit(False)
    for a in ALPHABETS:
        p, q = F.position(F.lower(letter), F.lit(a)), F.position(F.lower(nxt), F.lit(a))
        hit = hit | ((p > 0) & (q == p + 1))
    return hit & (F.length(letter) == 1) & (F.length(nxt) == 1)


def legal_label(text: Column, emphasis: Column | None = None) -> Column:
    """struct(kind, level, number, explicit) of a paragraph's label, or null.

    A word label needs a number and then white space, a mark or the end; if a
    citing word follows, it is a citation, unless the text stands out as a
    heading.  A bare ``3.`` or ``3)`` is a clause candidate, a bare letter a
    point candidate; both are not explicit.
    """
    heading = F.lit(False) if emphasis is None else F.coalesce(emphasis, F.lit(False))
    number = r"([0-9]+[a-zđ]?|[ivxlcdm]+|[a-zđ])"
    out = F.lit(None)
    for kind, level, words in reversed(LEVELS):
        head = rf"(?iu)^\s*(?:{words})\s+{number}(?=$|[\s.:)–—-])"
        cites = text.rlike(rf"(?u)^\s*(?i:(?:{words})\s+{number})\s+(?:{CITING})(?:$|\s)") & ~heading  # a title in capitals cites nothing
        found = F.struct(F.lit(kind).alias("kind"), F.lit(level).alias("level"), F.lower(F.regexp_extract(text, head, 1)).alias("number"), F.lit(True).alias("explicit"))
        out = F.when(text.rlike(head), F.when(~cites, found)).otherwise(out)
    bare = lambda p, kind, level: F.struct(F.lit(kind).alias("kind"), F.lit(level).alias("level"), F.lower(F.regexp_extract(text, p, 1)).alias("number"), F.lit(False).alias("explicit"))
    clause, point = r"^\s*([0-9]{1,3})[.)](?=\s|$)", r"(?iu)^\s*([a-zđ])[.)](?=\s|$)"
    worded = F.lit(False)
    for _, _, words in LEVELS:
        worded = worded | text.rlike(rf"(?iu)^\s*(?:{words})\s+{number}(?=$|[\s.:)–—-])")
    return F.when(worded, out).when(text.rlike(clause), bare(clause, "clause", 60)).when(text.rlike(point), bare(point, "point", 70))


def hierarchy(blocks: DataFrame, keys: list[str], order: str, text: str = "text", emphasis: str | None = None) -> DataFrame:
    """Labelled blocks with parent, parent_status and duplicate.

    The parent is the latest block before of a strictly lower level: a stack
    from which equal and higher levels are popped.  A clause without an article
    above it, or a point without a clause, is unresolved; a label is a
    duplicate if its parent already has one of its kind and number.
    """
    label = legal_label(F.col(text), F.col(emphasis) if emphasis else None)
    found = blocks.withColumn("_label", label).where("_label is not null").select(*keys, order, text, "_label.*")
    rank = F.create_map(*[F.lit(x) for i, (_, level, _) in enumerate(LEVELS) for x in (level, i)])[F.col("_level")]
    tree = nearest_parent(found.withColumn("_order", F.col(order)).withColumnRenamed("level", "_level"), keys, ["_order"], order, rank, len(LEVELS))
    tree = tree.drop("level", "_order").withColumnRenamed("_level", "level")
    above = tree.select(*keys, F.col(order).alias("parent"), F.col("kind").alias("parent_kind"))
    tree = tree.join(above, [*keys, "parent"], "left")
    needs = F.when(F.col("kind") == "clause", "article").when(F.col("kind") == "point", "clause")
    status = F.when(needs.isNotNull() & ~F.col("parent_kind").eqNullSafe(needs), "unresolved").otherwise("resolved")
    again = F.row_number().over(Window.partitionBy(*keys, "parent", "kind", "number").orderBy(order)) > 1
    return tree.withColumn("parent_status", status).withColumn("duplicate", again)


def clause_evidence(df: DataFrame, keys: list[str], order: str, number: str, barrier: Column | None = None, next_point: Column | None = None, style: Column | None = None, procedural: Column | None = None, form_field: Column | None = None, steps: Column | None = None) -> DataFrame:
    """Score and decision for numbered candidates in their article.

    .35 for the article, .25 for a previous and .25 for a next sequential
    number with no barrier between, .15 once if either is, .30 for a following
    point a or .20 for b, .10 for the style; .35 off in a procedural context,
    .35 for a form field, .30 for steps; clipped to [0, 1] and rounded to 2.
    From .70 a candidate is promoted unless a form field or a procedural
    context speaks against it, from .45 it stays a candidate.
    """
    no = F.lit(False)
    yes = lambda c: F.coalesce(c, no) if c is not None else no
    w = Window.partitionBy(*keys).orderBy(order)
    island = F.sum(yes(barrier).cast("int")).over(w) if barrier is not None else F.lit(0)
    x = df.withColumn("_i", island)
    n = F.col(number)
    prev = F.coalesce((F.lag(number).over(w) == n - 1) & (F.lag("_i").over(w) == F.col("_i")), no)
    nxt = F.coalesce((F.lead(number).over(w) == n + 1) & (F.lead("_i").over(w) == F.col("_i")), no)
    x = x.withColumn("_p", prev).withColumn("_n", nxt)
    point = F.lit(0.0) if next_point is None else F.when(next_point == "a", 0.30).when(next_point == "b", 0.20).otherwise(0.0)
    add = lambda c, v: F.when(c, v).otherwise(0.0)
    raw = F.lit(0.35) + add(F.col("_p"), 0.25) + add(F.col("_n"), 0.25) + add(F.col("_p") | F.col("_n"), 0.15) + point + add(yes(style), 0.10) - add(yes(procedural), 0.35) - add(yes(form_field), 0.35) - add(yes(steps), 0.30)
    score = F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw)), 2)
    x = x.withColumn("score", score)
    veto = yes(form_field) | yes(procedural)
    decision = F.when((F.col("score") >= 0.70) & ~veto, "clause").when(F.col("score") >= 0.45, "candidate").otherwise("numbered_paragraph")
    return x.withColumn("decision", decision).drop("_i", "_p", "_n")


def prefix_parents(df: DataFrame, keys: list[str], order: str, path: str) -> DataFrame:
    """For decimal labels such as 2.1.3 the latest 2.1 before it in the same scope, and whether it is missing or out of sequence."""
    digits = F.transform(F.split(path, r"\."), lambda s: s.cast("int"))
    x = df.withColumn("number_path", digits).withColumn("_up", F.array_join(F.slice(F.split(path, r"\."), 1, F.greatest(F.size("number_path") - 1, F.lit(0))), "."))
    at = x.select(*keys, F.col(path).alias("_up"), F.col(order).alias("_at"))
    # as-of: nodes and those that look for a parent in one order, by what they are called
    both = at.withColumn("_kind", F.lit(0)).unionByName(x.where("_up <> ''").select(*keys, "_up", F.col(order).alias("_at")).withColumn("_kind", F.lit(1)))
    w = Window.partitionBy(*keys, "_up").orderBy("_at", "_kind")
    found = both.withColumn("parent", F.last(F.when(F.col("_kind") == 0, F.col("_at")), ignorenulls=True).over(w)).where("_kind = 1").select(*keys, F.col("_at").alias(order), "parent")
    out = x.join(found, [*keys, order], "left")
    seq = Window.partitionBy(*keys, "parent", F.size("number_path")).orderBy(order)
    before = F.lag(F.element_at("number_path", -1)).over(seq)
    issue = F.when((F.col("_up") != "") & F.col("parent").isNull(), "prefix_parent_missing_in_current_annex_scope").when(before >= F.element_at("number_path", -1), "numbering_sequence_conflict")
    return out.withColumn("issue", issue).drop("_up")
