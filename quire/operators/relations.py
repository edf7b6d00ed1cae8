"""Operators that are relations from end to end: no Python below the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import blocks as B


# ---- blocks
def split_lines(texts: DataFrame, doc: str, page: str, text: str = "text") -> DataFrame:
    """``doc, page, block_no, line``: the lines of each page, in order."""
    return texts.select(F.col(doc).alias("doc"), F.col(page).alias("page"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("block_no", "line"))


def as_paragraphs(lines: DataFrame) -> DataFrame:
    return lines.select("doc", "page", "block_no", F.concat(F.lit("<p>"), "line", F.lit("</p>")).alias("html"))


def markdown_blocks(pages: DataFrame, *keep: str, md: str = "md") -> DataFrame:
    """``keep, block_no, block``: what blank lines part in a trimmed page."""
    trimmed = F.regexp_replace(F.col(md), r"^\s+|\s+\z", "")
    return pages.select(*keep, F.posexplode(F.split(trimmed, r"\n[ \t]*\n", -1)).alias("block_no", "block"))


# ---- running furniture
def furniture(blocks: DataFrame, *, min_sentences: int = 3) -> DataFrame:
    """``doc, key`` of running headers and footers: candidates that recur in a
    document (digits aside), as a paragraph somewhere or with digits and all, and
    not just as sentences unless there are three.

    Two aggregations by key, combined map-side; a document of any length works.
    """
    html = F.col("html")
    seen = blocks.select(
        "doc",
        B.furniture_candidate.col(html).alias("key"),
        B.furniture_verbatim.col(html).alias("verbatim"),
        B.is_plain_paragraph.col(html).alias("prose"),
        (~B.furniture_sentence.col(html)).alias("loose"),
    ).where("key is not null")
    # one row per document and verbatim text, then one per key
    texts = seen.groupBy("doc", "key", "verbatim").agg(F.count("*").alias("n"), F.max("prose").alias("prose"), F.max("loose").alias("loose"))
    cited = F.col("verbatim").rlike(r"\d") & (F.col("n") > 1)
    keys = texts.groupBy("doc", "key").agg(F.sum("n").alias("n"), F.max("prose").alias("prose"), F.max("loose").alias("loose"), F.max(cited).alias("cited"))
    return keys.where((F.col("n") > 1) & (F.col("prose") | F.col("cited")) & (F.col("loose") | (F.col("n") >= min_sentences))).select("doc", "key")


def without_furniture(blocks: DataFrame) -> DataFrame:
    """``blocks`` without running furniture and bare page numbers. The keys of
    the furniture are a small table; Spark broadcasts it if it is, and splits
    hot keys otherwise."""
    marked = blocks.withColumn("__key", F.coalesce(B.furniture_candidate.col(F.col("html")), F.lit("")))
    running = furniture(blocks).withColumnRenamed("key", "__key")
    return marked.where(~B.is_page_number.col(F.col("html"))).join(running, ["doc", "__key"], "left_anti").select(blocks.columns)


def license_footers(blocks: DataFrame, *order: str) -> DataFrame:
    """``doc, html``: the first of two or more license footers of a document."""
    found = blocks.where(B.is_license_footer.col(F.col("html")))
    return found.groupBy("doc").agg(F.min_by("html", F.struct(*order)).alias("html"), F.count("*").alias("n")).where("n > 1").select("doc", "html")


def recurring_lines(lines: DataFrame, *, pages: int = 3, chars: int = 6) -> DataFrame:
    """``doc, key, n``: lines, digit runs masked, that three or more pages have."""
    text = F.col("line")
    for pattern, to in ((r"<[^>]+>", " "), (r"[*_`#>|]+", " "), (r"[‐-―−]", "-"), (r"\d+", "#"), (r"\s+", " ")):
        text = F.regexp_replace(text, pattern, to)
    keys = lines.select("doc", "page", F.lower(F.trim(text)).alias("key")).where(F.length("key") >= chars)
    return keys.distinct().groupBy("doc", "key").agg(F.count("*").alias("n")).where(F.col("n") >= pages)


def mode_share(texts: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """``keep, words, top, degenerate``: words of a text, its commonest word's
    count, and whether that is a wall of one word."""
    words = texts.select(*keep, F.explode(F.regexp_extract_all(B.visible.col(F.col(text)), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))).alias("word"))
    counts = words.groupBy(*keep, "word").agg(F.count("*").alias("n"))
    out = counts.groupBy(*keep).agg(F.sum("n").alias("words"), F.max("n").alias("top"))
    return out.withColumn("degenerate", (F.col("words") >= 8) & (F.col("top") >= 0.6 * F.col("words")))


# ---- first pages
def first_where(rows: DataFrame, doc: str, order: str, test: Column) -> DataFrame:
    """``doc, first``: the least ``order`` where the test holds, else 0."""
    return rows.groupBy(doc).agg(F.coalesce(F.min(F.when(F.coalesce(test, F.lit(False)), F.col(order))), F.lit(0)).alias("first"))


# ---- neighbours
def joined_labels(blocks: DataFrame) -> DataFrame:
    """Lone table labels with the paragraph behind them, which goes; of a run of
    labels every second one takes the next (``doc, seq, html``)."""
    w = Window.partitionBy("doc").orderBy("seq")
    html, after = F.col("html"), F.lead("html").over(w)
    takes = B.bare_table_label.exists().col(html) & F.coalesce(B.plain_paragraph.exists().col(after) & ~B.opens_caption.col(B.plain_paragraph.col(after)), F.lit(False))
    rows = blocks.select("*", takes.alias("takes"), after.alias("after"))
    # within a run of takers, the odd ones take
    rows = rows.withColumn("run", F.sum((~F.col("takes")).cast("int")).over(w))
    place = F.row_number().over(Window.partitionBy("doc", "run", "takes").orderBy("seq"))
    rows = rows.withColumn("takes", F.col("takes") & (place % 2 == 1))
    rows = rows.withColumn("taken", F.coalesce(F.lag("takes").over(w), F.lit(False)))
    label = F.regexp_replace(B.bare_table_label.col(html), r"\s+\z", "")
    title = F.regexp_replace(B.plain_paragraph.col(F.col("after")), r"^\s+", "")
    joined = F.concat(F.lit("<p>"), label, F.lit(" "), title, F.lit("</p>"))
    return rows.where(~F.col("taken")).select("doc", "seq", F.when(F.col("takes"), joined).otherwise(html).alias("html"))


def nearest_captions(blocks: DataFrame) -> DataFrame:
    """``doc, seq, before, after``: for each table without a caption, the place
    of the nearest free caption on either side with only figures between."""
    html = F.col("html")
    kind = F.when(B.is_table_caption.col(html), "caption").when(B.is_figure.col(html), "figure").when(B.is_table.col(html) & ~B.has_caption_tag.col(html), "table").otherwise("other")
    rows = blocks.select("doc", "seq", kind.alias("kind"))
    w = Window.partitionBy("doc").orderBy("seq")
    back = w.rowsBetween(Window.unboundedPreceding, -1)
    ahead = w.rowsBetween(1, Window.unboundedFollowing)
    stop = F.when(F.col("kind") != "figure", F.struct("kind", "seq"))
    rows = rows.withColumns({"p": F.last(stop, ignorenulls=True).over(back), "n": F.first(stop, ignorenulls=True).over(ahead)})
    at = lambda c: F.when(F.col(c)["kind"] == "caption", F.col(c)["seq"])
    return rows.where("kind = 'table'").select("doc", "seq", at("p").alias("before"), at("n").alias("after"))


def fused_letters(rows: DataFrame) -> DataFrame:
    """``doc, seq, letters``: runs of neighbouring tables whose letters go on
    from each other, by the first one's place. ``letter`` is null elsewhere."""
    w = Window.partitionBy("doc").orderBy("seq")
    code = F.ascii("letter")
    goes_on = F.coalesce(code == F.lag(code).over(w) + 1, F.lit(False))
    runs = rows.withColumn("run", F.sum((~goes_on).cast("int")).over(w)).where("letter is not null")
    out = runs.groupBy("doc", "run").agg(F.min("seq").alias("seq"), F.array_sort(F.collect_list(F.struct("seq", "letter"))).alias("l"))
    return out.select("doc", "seq", F.array_join(F.transform("l", lambda x: x["letter"]), "").alias("letters"))


def gathered_references(blocks: DataFrame) -> DataFrame:
    """``doc, seq, start, items``: behind the references heading, runs of
    numbered paragraphs as one list."""
    html = F.col("html")
    w = Window.partitionBy("doc").orderBy("seq")
    inside = F.coalesce(F.max(B.is_reference_heading.col(html)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    rows = blocks.select("doc", "seq", "html", (inside & B.is_numbered_reference.col(html)).alias("item"))
    rows = rows.withColumn("run", F.sum((~F.col("item")).cast("int")).over(w)).where("item")
    runs = rows.groupBy("doc", "run").agg(F.min("seq").alias("seq"), F.min_by(B.reference_number.col(html), "seq").alias("start"), F.array_sort(F.collect_list(F.struct("seq", B.reference_text.col(html).alias("t")))).alias("l"))
    return runs.select("doc", "seq", "start", F.array_join(F.transform("l", lambda x: x["t"]), " / ").alias("items"))


def footnotes_before_references(blocks: DataFrame) -> DataFrame:
    """``doc, place, html``: footnotes (``note``) moved before the references
    heading, else the first ``[1]`` paragraph, else to the end."""
    body = F.when(~F.col("note"), F.col("html"))
    every = Window.partitionBy("doc")
    heading = F.min(F.when(B.is_reference_heading.col(body), F.col("seq"))).over(every)
    section = F.min(F.when(B.opens_references.col(body), F.col("seq"))).over(every)
    at = F.coalesce(heading, section, F.max("seq").over(every) + 1)
    rows = blocks.select("doc", "seq", "html", "note", at.alias("at"))
    rank = F.when(F.col("note"), F.struct(F.col("at").alias("at"), F.lit(0).alias("k"), F.col("seq").alias("seq"))).otherwise(F.struct(F.col("seq").alias("at"), F.lit(1).alias("k"), F.col("seq").alias("seq")))
    return rows.select("doc", F.row_number().over(Window.partitionBy("doc").orderBy(rank)).alias("place"), "html")


def reflow_breaks(lines: DataFrame) -> DataFrame:
    """``doc, paragraph, first_line, n_lines``: lines of a soft-wrapped block
    as paragraphs: a break where a sentence ends though the next word would fit."""
    w = Window.partitionBy("doc").orderBy("block_no")
    rows = lines.select("doc", "block_no", F.trim(B.visible.col(F.col("line"))).alias("seen"))
    width = F.max(F.length("seen")).over(Window.partitionBy("doc"))
    word = F.length(F.substring_index(F.lead("seen").over(w), " ", 1))
    breaks = B.line_ends_sentence.col(F.col("seen")) & (F.length("seen") + 1 + word <= width)
    rows = rows.withColumn("breaks", F.coalesce(breaks, F.lit(False)).cast("int"))
    rows = rows.withColumn("paragraph", F.coalesce(F.sum("breaks").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return rows.groupBy("doc", "paragraph").agg(F.min("block_no").alias("first_line"), F.count("*").alias("n_lines"))


# ---- tables
def cells(table: Column) -> Column:
    """Visible texts of the cells that have any."""
    inner = F.regexp_extract_all(table, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1))
    return F.filter(F.transform(inner, lambda c: F.trim(F.regexp_replace(c, "<[^>]+>", ""))), lambda c: c != "")


def columns(table: Column) -> Column:
    """The widest row, spans counted; at least 1."""
    rows = F.regexp_extract_all(table, F.lit(r"(?is)<tr\b.*?</tr>"), F.lit(0))
    span = lambda a: F.coalesce(F.expr("try_cast(1 as int)") * F.nullif(F.regexp_extract(a, r"""(?i)colspan\s*=\s*["']?(\d+)""", 1), F.lit("")).cast("int"), F.lit(1))
    width = lambda row: F.aggregate(F.regexp_extract_all(row, F.lit(r"(?i)<t[dh]\b([^>]*)>"), F.lit(1)), F.lit(0), lambda n, a: n + span(a))
    return F.greatest(F.coalesce(F.array_max(F.transform(rows, width)), F.lit(1)), F.lit(1))


def closed(md: Column) -> Column:
    """Missing ``</table>`` tags added at the end."""
    missing = F.regexp_count(md, F.lit(r"(?i)<table\b")) - F.regexp_count(md, F.lit(r"(?i)</table\s*>"))
    return F.when(missing > 0, F.concat(F.regexp_replace(md, r"\s+\z", ""), F.repeat(F.lit("</table>"), missing))).otherwise(md)


def collapsed_runs(rows: DataFrame, group: str, order: Sequence[str], value: str, *, most: int = 3) -> DataFrame:
    """``rows`` without the repeats in runs of more than ``most`` equal
    neighbours: gaps and islands by two row numbers."""
    every = Window.partitionBy(group).orderBy(*order)
    alike = Window.partitionBy(group, value).orderBy(*order)
    rows = rows.withColumn("__island", F.row_number().over(every) - F.row_number().over(alike))
    own = Window.partitionBy(group, value, "__island")
    rows = rows.withColumns({"__n": F.count("*").over(own), "__k": F.row_number().over(own.orderBy(*order))})
    return rows.where((F.col("__n") <= most) | (F.col("__k") == 1)).drop("__island", "__n", "__k")


# ---- boxes and glyphs
def to_pixels(box: Sequence[Column], width: Column, height: Column) -> list[Column]:
    """Thousandths as pixels, halves to even."""
    return [F.bround(v / 1000 * d).cast("int") for v, d in zip(box, (width, height, width, height), strict=True)]


def glyph_lines(glyphs: DataFrame) -> DataFrame:
    """``page, line, l, b, r, t, n``: glyph boxes as lines. Downwards, a box
    whose top is not above all bottoms so far begins a line: intervals merged by
    a running minimum."""
    w = Window.partitionBy("page").orderBy(F.desc("t"), "pos")
    low = F.min("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = glyphs.withColumn("__new", F.coalesce(F.col("t") <= low, F.lit(True)).cast("int"))
    rows = rows.withColumn("line", F.sum("__new").over(w))
    return rows.groupBy("page", "line").agg(F.min("l").alias("l"), F.min("b").alias("b"), F.max("r").alias("r"), F.max("t").alias("t"), F.count("*").alias("n"))


def glyphs_in_boxes(glyphs: DataFrame, boxes: DataFrame) -> DataFrame:
    """``page, box, text``: characters whose centre is in the box, in order; the
    page is the equality that keeps the range join small."""
    x, y = (F.col("l") + F.col("r")) / 2, (F.col("b") + F.col("t")) / 2
    inside = x.between(F.col("x0"), F.col("x1")) & y.between(F.col("y0"), F.col("y1"))
    hit = glyphs.join(boxes, "page").where(inside)
    found = hit.groupBy("page", "box").agg(F.array_sort(F.collect_list(F.struct("pos", "ch"))).alias("c"))
    return found.select("page", "box", F.array_join(F.transform("c", lambda g: g["ch"]), "").alias("text"))


def main_turns(glyphs: DataFrame) -> DataFrame:
    """``page, turn``: the commonest turn; 0 wins ties, then the smallest."""
    counts = glyphs.where("turn is not null").groupBy("page", "turn").agg(F.count("*").alias("n"))
    return counts.groupBy("page").agg(F.min_by("turn", F.struct((-F.col("n")).alias("n"), (F.col("turn") != 0).alias("z"), "turn")).alias("turn"))


def line_spacing(lines: DataFrame) -> DataFrame:
    """``page, spacing``: the median gap between successive lines."""
    gap = F.col("b") - F.lead("t").over(Window.partitionBy("page").orderBy("line"))
    return lines.select("page", gap.alias("gap")).where("gap is not null").groupBy("page").agg(F.median("gap").alias("spacing"))


def missing_figures(captioned: DataFrame, emitted: DataFrame) -> DataFrame:
    """``doc, number, pages``: figures that the text layer captions and the
    transcript does not, with the pages that do."""
    lacking = captioned.join(emitted.select("doc", "number").distinct(), ["doc", "number"], "left_anti")
    return lacking.groupBy("doc", "number").agg(F.array_join(F.transform(F.sort_array(F.collect_set("page")), lambda p: p.cast("string")), ",").alias("pages"))


def figure_numbers(pages: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """``keep, number`` of figures whose caption label begins a line."""
    found = F.regexp_extract_all(F.col(text), F.lit(r"(?im)^[ \t]*(?:\*{1,2}[ \t]*)?fig(?:ure|\.)?\.?[ \t]*(\d+)(?:[ \t]*\r?$|[ \t]*[.:|)]|[ \t]+[A-Z(])"), F.lit(1))
    return pages.select(*keep, F.explode(found).alias("number")).select(*keep, F.col("number").cast("int").alias("number"))


def contribution_markers(bylines: DataFrame, key: str, text: str) -> DataFrame:
    """``key, marker``: the symbol that most authors share, twice at least; of
    equals the first to appear."""
    chars = bylines.select(key, F.posexplode(F.split(F.col(text), "")).alias("pos", "ch")).where(F.col("ch").isin(*"*†‡§¶"))
    counts = chars.groupBy(key, "ch").agg(F.count("*").alias("n"), F.min("pos").alias("first")).where("n >= 2")
    return counts.groupBy(key).agg(F.min_by("ch", F.struct((-F.col("n")).alias("n"), "first")).alias("marker"))
