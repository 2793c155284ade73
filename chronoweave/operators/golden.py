"""Golden samples of pages: frames with exact probabilities, progress and agreement of labelling, scores by page and by document,
exports that hold no personal data, and attachments inside statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.values import unit_hash
from chronoweave.operators.text import personal_data


def frame(pages: DataFrame, entities: DataFrame, rates: dict[str, float], seed: str) -> DataFrame:
    """The pages drawn, with ``stratum``, ``pi`` and ``draw_position``, in no order but that.

    ``pages``: krs, document_ref, page, answered (the model found the signal), read (the document was read at all). ``entities``: krs,
    weight (1 / its own probability). A page answered present is drawn by its document, so a document's pages share a position; others
    by page. A drawn page of a document that wasn't read is an error.
    """
    stratum = F.when(F.col("answered"), "present").otherwise("absent")
    rate = F.when(F.col("answered"), F.lit(rates["present"])).otherwise(F.lit(rates["absent"]))
    by_document = unit_hash(F.col("krs"), F.col("document_ref"), seed=seed)
    by_page = unit_hash(F.col("krs"), F.col("document_ref"), F.col("page"), seed=seed)
    rows = pages.join(entities.select("krs", "weight"), "krs").withColumns({"stratum": stratum, "u": F.when(F.col("answered"), by_document).otherwise(by_page)})
    drawn = rows.filter(F.col("u") < rate).withColumns({"pi": rate / F.col("weight"), "draw_position": F.col("u") / rate})
    unread = drawn.filter(~F.col("read")).limit(1).collect()
    if unread:
        raise ValueError(f"{unread[0]['document_ref']} is in the draw but was not read")
    return drawn.drop("u", "weight", "read")


def progress(queue: DataFrame, by: list[str]) -> DataFrame:
    """Of each queue: its pages, those labelled, and how many from the start are labelled without a gap.

    ``queue``: draw_position and labelled. The first open position is an aggregate, so no queue is ordered in one task.
    """
    first = queue.groupBy(*by).agg(F.min(F.when(~F.col("labelled"), F.col("draw_position"))).alias("_open"))
    met = queue.join(first, by) if by else queue.crossJoin(F.broadcast(first))
    before = F.col("_open").isNull() | (F.col("draw_position") < F.col("_open"))
    return met.groupBy(*by).agg(F.count("*").alias("pages"), F.count_if("labelled").alias("labelled"), F.count_if(before).alias("complete_prefix"))


def agreement(labels: DataFrame, page: list[str], by: list[str]) -> DataFrame:
    """Pages labelled more than once: how many got one answer, and how many several. ``labels``: the page, label and labelled_at."""
    told = labels.groupBy(*by, *page).agg(F.count("*").alias("n"), F.count_distinct(F.coalesce("label", F.lit("~"))).alias("answers"))
    return told.filter("n > 1").groupBy(*by).agg(F.count("*").alias("rechecked"), F.count_if(F.col("answers") == 1).alias("agreed"), F.count_if(F.col("answers") > 1).alias("disagreed"))


def weighted_scores(rows: DataFrame, by: list[str], truth: str, said: str, pi: Column) -> DataFrame:
    """Precision and recall of flags, each row for 1 / pi rows of the whole."""
    w = 1 / pi
    add = lambda test: F.coalesce(F.sum(F.when(test, w)), F.lit(0.0))
    t, s = F.col(truth), F.col(said)
    counted = rows.groupBy(*by).agg(F.count("*").alias("n_rows"), add(t & s).alias("tp"), add(~t & s).alias("fp"), add(t & ~s).alias("fn"))
    return counted.withColumns({"precision": F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0.0)), "recall": F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0.0))})


def by_document(pages: DataFrame, document: list[str], truth: str, said: str) -> DataFrame:
    """A document is flagged if any of its pages is; it counts by its least probable page."""
    return pages.groupBy(*document).agg(F.bool_or(truth).alias(truth), F.bool_or(said).alias(said), F.min("pi").alias("pi"))


def export(pages: DataFrame, text: str) -> DataFrame:
    """Pages fit to leave: refused whole if any still holds personal data."""
    left = pages.filter(F.size(personal_data(F.col(text))) > 0).limit(1).collect()
    if left:
        raise ValueError("a page holds personal data that is not masked")
    return pages


def masker_recall(pages: DataFrame, planted: str, masked: str) -> DataFrame:
    """(spans, hidden, recall) of planted spans (an array column) that the masked text no longer holds."""
    each = pages.select(F.explode(planted).alias("span"), F.col(masked).alias("masked"))
    counted = each.agg(F.count("*").alias("spans"), F.count_if(F.instr(F.col("masked"), F.col("span")) == 0).alias("hidden"))
    return counted.withColumn("recall", F.col("hidden") / F.nullif(F.col("spans"), F.lit(0)))


def attachments(statements: DataFrame, element: str) -> DataFrame:
    """(file_id, place, content): the base64 contents of a statement's elements of one name, in their order; what isn't base64 is null."""
    found = F.xpath("xml", F.lit(f"//*[local-name()='{element}']/text()"))
    rows = statements.select("file_id", F.posexplode(found).alias("place", "coded"))
    plain = F.regexp_replace("coded", r"\s+", "")
    good = plain.rlike(r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$")
    return rows.select("file_id", F.col("place").cast("int").alias("place"), F.when(good, F.unbase64(plain)).alias("content"))


def opinion(text: Column, headings: str, rules: list[tuple[str, str]]) -> Column:
    """The class of an opinion: a heading that names one decides, else the patterns by severity.

    Of the rules in order of severity the first that a heading line matches; if none does, the first that the text matches.
    """
    titles = F.array_join(F.filter(F.split(text, "\n"), lambda line: line.rlike(headings)), "\n")
    out = F.lit(None).cast("string")
    for name, pattern in reversed(rules):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    for name, pattern in reversed(rules):
        out = F.when(titles.rlike(pattern), name).otherwise(out)
    return out
