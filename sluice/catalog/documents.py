"""Document text operators over notes and documents."""

from pyspark.sql import functions as F

from sluice.catalog.registry import query
from sluice.catalog.views import EARLY, NOTES_SRC, duck, notes_src, table
from sluice.functions.text import WHITE_RANGES, normalize_text
from sluice.operators import documents as D
from sluice.operators.merge import upsert
from sluice.plans.documents import run_documents
from sluice.session import fresh_folder

NOTES = duck(NOTES_SRC)
RUN, AT = "run-2", "2001-01-01T00:00:00"


_WHITE = "".join(f"\\x{{{low:x}}}-\\x{{{high:x}}}" for low, high in WHITE_RANGES)


def _strip(x):
    return f"regexp_replace({x}, '^[{_WHITE}]+|[{_WHITE}]+$', '', 'g')"


def _normal(x):
    return _strip(
        f"regexp_replace(regexp_replace(replace({x}, chr(13), chr(10)), '[ \\t]+', ' ', 'g'), '\\n{{2,}}', chr(10), 'g')")


def _first(x, pattern, flags="i"):
    got = f"regexp_extract({x}, '(?{flags}){pattern.replace(chr(39), chr(39) * 2)}', 1)"
    return f"case when {got} <> '' then {_strip(got)} end"


def _class(x, parity=True):
    tests = []
    for label, patterns in D.CLASS_PATTERNS:
        used = [p for p in patterns if not (parity and p == D.CAPITALS_ONLY)]
        tests.append(f"when regexp_matches(lower({x}), '{'|'.join(used)}') then '{label}'")
    return f"case {' '.join(tests)} end"


_FIELDS = ", ".join(f"{_first('full_text', p)} {n}" for n, p in D.FIELD_PATTERNS.items())
_FOUND = " + ".join(f"case when length({n}) > 0 then 1 else 0 end" for n in D.FIELDS)
_PARSED = f"""notes as (select doc_id, txt, {_normal('txt')} full_text from {NOTES} n),
parsed as (select doc_id, txt, full_text, {_class('full_text')} document_type, {_FIELDS} from notes),
scored as (select *, round(least(({_FOUND}) / 9.0
  + case when document_type is null then 0.0 else 0.1 end, 1.0), 2) score,
  case when length({_strip('txt')}) >= 100 then 'direct_pdf_text' else 'direct_pdf_text_weak' end extraction_method
  from parsed)"""


def notes(spark, sf_dir, null_text=None):
    """Notes as documents; ``null_text`` marks those without readable text."""
    df = notes_src(spark, sf_dir)
    if null_text is not None:
        df = null_text(df)
    return df.select(
        F.concat(F.lit("notes/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_path"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"),
        F.col("txt").alias("text"))


def doc_number(c="file_name"):
    return F.regexp_extract(c, "[0-9]+", 0).cast("bigint").alias("doc_id")


def parsed_notes(spark, sf_dir, *columns):
    wanted = {"columns": ["file_name", *columns]} if columns else {}
    return D.parse_documents(notes(spark, sf_dir), RUN, AT, **wanted)


@query(f"""select doc_id, {_normal('text')} normalized, length({_strip('text')}) >= 100 is_direct from documents""")
def text_normalize(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", normalize_text("text").alias("normalized"),
        (D.method_label("text") == "direct_pdf_text").alias("is_direct"))


@query(f"""with docs as (select doc_id, {_normal('text')} full_text from documents)
select doc_id, {_class('full_text', False)} document_type from docs""")
def document_classify(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    texts = D.with_normal_text(docs.select("doc_id", "text"), "text")
    return texts.select("doc_id", D.classify("full_text", parity=False).alias("document_type"))


@query(f"with {_PARSED} select doc_id, document_type from scored")
def note_classify(spark, sf_dir):
    return parsed_notes(spark, sf_dir, "document_type").select(doc_number(), "document_type")


@query(f"with {_PARSED} select doc_id, {', '.join(D.FIELDS)}, substr(full_text, 1, 1000) raw_text_preview from scored")
def note_fields(spark, sf_dir):
    return parsed_notes(spark, sf_dir, *D.FIELDS, "raw_text_preview").select(doc_number(), *D.FIELDS, "raw_text_preview")


def _labelled(name):
    tries = [_first("full_text", p, "im" if p.startswith("^") else "i") for p in D.LABELLED_PATTERNS[name]]
    return f"coalesce({', '.join(f'nullif({t}, {chr(39) * 2})' for t in tries[:-1])}{', ' if tries[:-1] else ''}{tries[-1]}) {name}"


_TEN = ", ".join(_labelled(n) for n in D.LABELLED_PATTERNS)


@query(f"""with notes as (select doc_id, txt, {_normal('txt')} full_text from {NOTES} n)
select doc_id, {_TEN}, case when length({_strip('txt')}) >= 100 then 'direct_pdf_text'
  else 'direct_pdf_text_failed_no_ocr' end extraction_method from notes""")
def note_fields_v1(spark, sf_dir):
    parsed = D.parse_labelled(notes(spark, sf_dir))
    return parsed.select(doc_number(), *D.LABELLED_PATTERNS, "extraction_method")


@query(f"""with {_PARSED} select doc_id, cast(score as decimal(4,2)) score, score < 0.6 needs_review,
  extraction_method from scored""")
def note_confidence(spark, sf_dir):
    return parsed_notes(spark, sf_dir).select(
        doc_number(), F.col("confidence_score").cast("decimal(4,2)").alias("score"),
        "needs_review", "extraction_method")


@query(f"""with {_PARSED} select doc_id, 'Low confidence score: ' || cast(cast(score as double) as varchar) reason,
  mrn payload_mrn from scored where score < 0.6""")
def note_review(spark, sf_dir):
    queue = D.review_queue(parsed_notes(spark, sf_dir), AT)
    return queue.select(
        doc_number(), "reason",
        F.get_json_object("payload", "$.parsed_document.mrn").alias("payload_mrn"))


@query(f"""select sha256('notes/' || cast(o_orderkey as varchar) || '.txt') document_id, 'run-2' run_id,
  case when o_orderdate < timestamp '{EARLY}' then 'update' else 'insert' end as "action" from orders""")
def doc_upsert(spark, sf_dir):
    """A first run over the older documents, a second over all of them."""
    early = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < EARLY).select(
        F.concat(F.lit("notes/"), F.col("o_orderkey").cast("string"), F.lit(".txt")).alias("file_path"))
    docs = notes(spark, sf_dir)
    shown = ["document_id", "run_id"]
    first = D.parse_documents(docs.join(early, "file_path", "left_semi"), "run-1", AT, columns=shown)
    merged = upsert(first, D.parse_documents(docs, RUN, AT, columns=shown), "document_id", "always")
    return merged.select("document_id", "run_id", "action")


def _unreadable(df):
    return df.withColumn("txt", F.when(~F.col("txt").contains("5-LOW"), F.col("txt")))


@query(f"""with {_PARSED} select count(*) filter (where not contains(txt, '5-LOW')) succeeded,
  count(*) filter (where contains(txt, '5-LOW')) failed,
  count(*) filter (where not contains(txt, '5-LOW') and score < 0.6) review_needed from scored""")
def doc_totals(spark, sf_dir):
    docs = notes(spark, sf_dir, _unreadable)
    return D.run_totals(docs, D.parse_documents(docs, RUN, AT))


@query(f"""with {_PARSED} select doc_id, 'Processing failure: no readable text' reason from scored
where contains(txt, '5-LOW')""")
def doc_failures(spark, sf_dir):
    _, failed = D.split_readable(notes(spark, sf_dir, _unreadable))
    return D.failure_queue(failed, AT).select(doc_number(), "reason")


@query(f"""with {_PARSED} select doc_id, 'run-2' run_id, document_type, {', '.join(D.FIELDS)},
  cast(score as decimal(4,2)) score, score < 0.6 needs_review from scored""")
def document_run(spark, sf_dir):
    """The whole run twice; records, queues and summary written, target read back."""
    from sluice.sinks.publish import read_version
    root = fresh_folder(spark, "document-run")
    docs = notes(spark, sf_dir)
    schema = D.parse_documents(docs, RUN, AT).schema
    for run in ("run-1", RUN):
        run_documents(spark, docs, f"{root}/out", run, AT, target=f"{root}/target")
    return read_version(spark, f"{root}/target", schema).select(
        doc_number(), "run_id", "document_type", *D.FIELDS,
        F.col("confidence_score").cast("decimal(4,2)").alias("score"), "needs_review")
