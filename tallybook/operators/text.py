"""Text blocks that hold tables: a title line, a header line, then rows of as many words.

Everything happens inside the row that holds the text, in time linear in its lines. Text is never
shuffled, and no window gathers a document's lines.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallybook.functions.cells import EMPTY_WORD, WHITE_SPACE, count_words, has_at_most, strip_space, words

# Fixed value: the word and colon that end a table's title.
TITLE_MARKER = "테이블:"

_UNUSUAL = "[^ -~]"  # what may be white space other than a blank
_FULL = r"(?U)[^\s\x1c-\x1f]"  # any other character
_MASK_BITS = 62  # places of a line that are held against those of other lines in one number


def marked_title(marker: str = TITLE_MARKER, whole_line: bool = False) -> Callable[[Column], Column]:
    """Lines holding ``marker`` are titles; the title is what stands before it, else NULL.

    A title line without a name ends the table before it and opens none. With ``whole_line`` the title is
    all of the line, which may name several tables.
    """
    def title(line: Column) -> Column:
        return F.when(F.contains(line, F.lit(marker)), line if whole_line else strip_space(F.substring_index(line, marker, 1)))

    return title


def short_title(most_words: int) -> Callable[[Column], Column]:
    """Lines of few words are titles."""
    return lambda line: F.when(has_at_most(line, most_words), line)


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _stripped_lines(text: Column) -> Column:
    return F.transform(_lines(text), strip_space)


def sections(
    docs: DataFrame, doc_id: str, text: str, title: Callable[[Column], Column],
    lines: Callable[[Column], Column] = _stripped_lines,
) -> DataFrame:
    """(doc, section_no, title, title_line, body): the lines between one title and the next, stripped unless
    ``lines`` says otherwise.

    Lines before the first title belong to no section, and so do those behind a title that is empty; its
    line has a section number all the same.
    """
    starts = F.filter(
        F.transform(
            F.col("_lines"), lambda line, i: F.struct((i + 1).alias("line_no"), title(line).alias("title"))
        ),
        lambda s: s["title"].isNotNull(),
    )

    def section(start: Column, i: Column) -> Column:
        end = F.coalesce(F.get("_starts", i + 1)["line_no"], F.size("_lines") + 1)
        body = F.slice("_lines", start["line_no"] + 1, end - start["line_no"] - 1)
        return F.struct(
            (i + 1).alias("section_no"), start["title"].alias("title"), start["line_no"].alias("title_line"),
            body.alias("body"),
        )

    # Each section takes its own lines along: exploding beside the whole text would copy all of it
    # once per section.
    return (
        docs.select(doc_id, lines(F.col(text)).alias("_lines"))
        .withColumn("_starts", starts)
        .select(doc_id, F.explode(F.transform("_starts", section)).alias("_section"))
        .select(doc_id, "_section.*")
        .where(F.col("title") != "")
    )


def section_lines(
    docs: DataFrame, doc_id: str, text: str, title: Callable[[Column], Column] = marked_title()
) -> DataFrame:
    """(doc, section_no, title, line_no, header, tokens): the table rows of every section.

    The first line with words after a title is the header. Rows are the lines with as many words
    as the header, up to the next blank line or title; lines of dashes are skipped.
    """
    body = F.col("body")
    header_at = F.array_position(F.transform(body, lambda line: line != ""), F.lit(True))
    after = F.slice(body, F.col("_at") + 1, F.size(body))
    blank_at = F.array_position(F.col("_after"), F.lit(""))
    block = F.when(blank_at > 0, F.slice("_after", F.lit(1), blank_at.cast("int") - 1)).otherwise(F.col("_after"))
    rows = F.filter(
        F.transform(
            block,
            lambda line, i: F.struct(
                (F.col("title_line") + F.col("_at") + i + 1).alias("line_no"), line.alias("line"), words(line).alias("tokens")
            ),
        ),
        lambda row: (F.size(row["tokens"]) == F.size("header")) & (F.translate(row["line"], "-" + WHITE_SPACE, "") != ""),
    )
    return (
        sections(docs, doc_id, text, title)
        .withColumn("_at", header_at.cast("int"))
        .where(F.col("_at") > 0)
        .withColumns({"header": words(F.get(body, F.col("_at") - 1)), "_after": after})
        .select(doc_id, "section_no", "title", "header", F.explode(rows).alias("_row"))
        .select(
            doc_id, "section_no", "title", F.col("_row.line_no").alias("line_no"), "header",
            F.col("_row.tokens").alias("tokens"),
        )
    )


def _title_places(line: Column, marker: str) -> Column:
    """(title, place) of every title on a line, in order; the place is where it starts, from 0."""
    parts = F.split(line, re.escape(marker))
    named = F.transform(
        F.slice(parts, F.lit(1), F.size(parts) - 1),
        lambda part, i: F.struct(
            strip_space(part).alias("title"),
            (
                F.length(F.array_join(F.slice(parts, F.lit(1), i), marker)) + F.when(i > 0, len(marker)).otherwise(0)
                + F.length(part) - F.length(F.ltrim(part, F.lit(WHITE_SPACE)))
            ).alias("place"),
        ),
    )
    return F.filter(named, lambda t: t["title"] != "")


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blanked(line: Column) -> Column:
    """A line with a blank for every white space; patterns for blanks are far cheaper than those for all of them."""
    return F.when(F.rlike(line, F.lit(_UNUSUAL)), F.translate(line, WHITE_SPACE, " " * len(WHITE_SPACE))).otherwise(line)


def _cuts(block: Column, titles: Column) -> Column:
    """Where the tables of a block start, from 0, one place a title. White space in ``block`` is blanks only.

    A cell of the header starts behind places that are blank in every line. Of these starts the tables
    but the first take the ones with the widest blanks in front, and among equals those nearest to a title.
    """

    def used(line: Column, size: Column) -> Column:
        # A digit a place: 1 where the line has something, else 0; as long as all chunks.
        digits = F.replace(F.regexp_replace(line, F.lit("[^ ]"), F.lit("1")), F.lit(" "), F.lit("0"))
        return F.rpad(digits, size, F.lit("0"))

    def marks(lines: Column, chunks: Column, width: Column) -> Column:
        def chunk(i: Column) -> Column:
            bits = F.aggregate(
                lines, F.lit(0).cast("bigint"),
                lambda so_far, line: so_far.bitwiseOR(F.conv(F.substring(line, i * _MASK_BITS + 1, F.lit(_MASK_BITS)), 2, 10).cast("bigint")),
            )
            return F.lpad(F.bin(bits), _MASK_BITS, "0")

        digits = F.array_join(F.transform(F.sequence(F.lit(0), chunks - 1), chunk), "")
        return F.translate(F.substring(digits, F.lit(1), width), "01", " x")

    def mask(width: Column) -> Column:
        chunks = F.ceil(width / _MASK_BITS).cast("int")
        return _with(chunks, lambda n: _with(
            _with(n * _MASK_BITS, lambda size: F.transform(block, lambda line: used(line, size))), lambda lines: marks(lines, n, width)
        ))

    def chosen(mask: Column) -> Column:
        # A start is where a run of marks begins, but for the first.
        runs = F.regexp_extract_all(mask, F.lit("( *x+)"), F.lit(1))
        begins = F.aggregate(
            runs, F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<narrow: int, far: int, at: int>>").alias("found")),
            lambda so_far, run: F.struct(
                (so_far["end"] + F.length(run)).alias("end"),
                F.when(
                    (so_far["end"] > 0) & run.startswith(" "), F.concat(so_far["found"], F.array(choice(so_far["end"], run)))
                ).otherwise(so_far["found"]).alias("found"),
            ),
        )["found"]
        return F.slice(F.array_sort(begins), F.lit(1), F.greatest(F.size(titles) - 1, F.lit(0)))

    def choice(end: Column, run: Column) -> Column:
        blanks = F.length(run) - F.length(F.ltrim(run))
        nearest = F.array_min(F.transform(
            F.slice(titles, F.lit(2), F.size(titles)), lambda t: F.abs(t["place"] - end - blanks)
        ))
        return F.struct((-blanks).alias("narrow"), nearest.alias("far"), (end + blanks).alias("at"))

    first = F.greatest(F.length(F.get(block, F.lit(0))), F.lit(1))
    picked = _with(_with(first, mask), chosen)
    return F.concat(F.array(F.lit(0)), F.array_sort(F.transform(picked, lambda c: c["at"])))


def _tables_of_block(block: Column, titles: Column, header_line: Column) -> Column:
    """(table_no, title, header, rows) of the tables of a block; ``header_line`` is the number of its first line.

    White space in ``block`` is blanks only.
    """

    def rows(cells: Column, header: Column) -> Column:
        told = F.transform(cells, lambda line, i: F.struct(
            (header_line + i).alias("line_no"), line.alias("line"), F.split(line, " +").alias("tokens"), i.alias("i")
        ))
        found = F.filter(told, lambda row: (
            (row["i"] > 0) & (F.size(row["tokens"]) == F.size(header)) & F.rlike(row["line"], F.lit("[^- ]"))
        ))
        return F.transform(found, lambda row: F.struct(row["line_no"].alias("line_no"), row["tokens"].alias("tokens")))

    def table(cuts: Column, start: Column, no: Column) -> Column:
        # Each table takes its own cut of the lines along.
        cells = _with(F.get(cuts, no + 1), lambda end: F.transform(block, lambda line: F.trim(
            F.substring(line, start + 1, F.when(end.isNotNull(), end - start).otherwise(F.length(line)))
        )))
        return _with(cells, lambda cells: F.when(F.get(cells, F.lit(0)) != "", _with(F.split(F.get(cells, F.lit(0)), " +"), lambda header: F.struct(
            (no + 1).alias("table_no"), F.get(titles, no)["title"].alias("title"), header.alias("header"), rows(cells, header).alias("rows")
        ))))

    return _with(_cuts(block, titles), lambda cuts: F.filter(
        F.transform(cuts, lambda start, no: table(cuts, start, no)), lambda found: found.isNotNull()
    ))


def _tables_of_section(body: Column, title: Column, title_line: Column, marker: str) -> Column:
    """The tables below a title line; NULL if there are none."""

    def block(full: Column, at: Column) -> Column:
        after = F.array_position(F.slice(full, at, F.size(full)), F.lit(False)).cast("int")
        return _with(after, lambda blank: F.slice(body, at, F.when(blank > 0, blank - 1).otherwise(F.size(body))))

    def tables(titles: Column, full: Column, at: Column) -> Column:
        return F.when((at > 0) & (F.size(titles) > 0), _with(
            F.transform(block(full, at), _blanked), lambda lines: _tables_of_block(lines, titles, title_line + at)
        ))

    return _with(_title_places(title, marker), lambda titles: _with(
        F.transform(body, lambda line: F.rlike(line, F.lit(_FULL))),
        lambda full: _with(F.array_position(full, F.lit(True)).cast("int"), lambda at: tables(titles, full, at)),
    ))


def block_tables(docs: DataFrame, doc_id: str, text: str, marker: str = TITLE_MARKER) -> DataFrame:
    """(doc, section_no, table_no, title, line_no, header, tokens): the rows of tables that stand side by side.

    A title line may name several tables. The lines below it, up to a blank line or the next title, are cut
    where blanks line up over all of them, and each cut is read as a table of its own: its first words are the
    header, rows are the lines with as many words as that, lines of dashes are skipped. A table may be shorter
    than its neighbours, on either side. If there are fewer cuts than titles, the last titles have no table. A
    title line with one title gives what ``section_lines`` does.

    Work is within the row, and grows with the text and with the length of headers. All of a section is one
    expression whose parts are bound to names: as columns of their own the planner would write them out wherever they are
    used, and compute them as often. Outer generators keep it from testing what they give beforehand.
    """
    found = F.explode_outer(_tables_of_section(F.col("body"), F.col("title"), F.col("title_line"), marker))
    return (
        sections(docs, doc_id, text, marked_title(marker, whole_line=True), _lines)
        .select(doc_id, "section_no", found.alias("_table"))
        .select(doc_id, "section_no", "_table", F.explode_outer("_table.rows").alias("_row"))
        .where(F.col("_row").isNotNull())
        .select(
            doc_id, "section_no", "_table.table_no", "_table.title", F.col("_row.line_no").alias("line_no"), "_table.header",
            F.col("_row.tokens").alias("tokens"),
        )
    )


def section_outline(docs: DataFrame, doc_id: str, text: str, title: Callable[[Column], Column]) -> DataFrame:
    """Lines, words and sections of each document."""
    titles = F.filter("_lines", lambda line: title(line).isNotNull())
    return (
        docs.select(doc_id, _stripped_lines(F.col(text)).alias("_lines"), count_words(F.col(text)).alias("words"))
        .select(doc_id, F.size("_lines").alias("lines"), "words", F.size(titles).alias("sections"))
    )


def typed_rows(rows: DataFrame, keys: list[str], fields: dict[str, str]) -> DataFrame:
    """Section rows as typed columns, found by header name.

    The word for a missing cell becomes NULL, and so does a cell that is not of the type.
    """
    def cell(name: str, kind: str) -> Column:
        at = F.array_position(F.col("header"), F.lit(name)).cast("int")
        word = F.get(F.col("tokens"), F.nullif(at, F.lit(0)) - 1)
        return F.nullif(word, F.lit(EMPTY_WORD)).try_cast(kind).alias(name)

    return rows.select(*keys, *[cell(n, k) for n, k in fields.items()])
