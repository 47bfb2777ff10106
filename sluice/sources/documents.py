"""Document text, one row per file."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.functions.paths import object_name
from sluice.functions.text import strip


def read_documents(spark: SparkSession, folder, pattern="*.txt") -> DataFrame:
    """(file_path, file_name, text) for every file of a folder that fits.

    Undecodable bytes give a null text, which the document job counts as a
    failure; other files are not affected.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
        .select(F.col("path").alias("file_path"), "content")
    )
    text = F.when(F.expr("is_valid_utf8(content)"), F.decode("content", "UTF-8"))
    return files.select("file_path", object_name("file_path").alias("file_name"), text.alias("text"))


def join_pages(pages: DataFrame, doc="doc_id", page="page_no", text="text",
               page_headers=False, pages_per_chunk=10_000) -> DataFrame:
    """(doc, text): pages in order, joined by a line feed.

    Scanned pages get a header line each; the joined text is stripped.  Long documents are joined in two
    steps, so that one task never orders more than a chunk of page rows and
    the last step sees one row per chunk.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    if page_headers:
        body = F.concat(F.lit("\n--- PAGE "), F.col(page).cast("string"), F.lit(" ---\n"), body)
    rows = pages.select(
        F.col(doc), F.floor(F.col(page) / pages_per_chunk).alias("chunk"),
        F.col(page).alias("part"), body.alias("body"),
    )

    def joined(part):
        items = F.sort_array(F.collect_list(F.struct(part, "body")))
        return F.array_join(F.transform(items, lambda i: i["body"]), "\n")

    chunks = rows.groupBy(doc, "chunk").agg(joined("part").alias("body"))
    return chunks.groupBy(doc).agg(strip(joined("chunk")).alias("text"))
