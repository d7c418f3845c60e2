"""From work list and artifacts to results: each route is a column pipeline, the best source wins per paper.

Artifacts are one table (doi, kind, content binary). A batch goes through the sources in the order of
their priority. Each stage sees only the papers that are still open and only their artifacts, fetches
what is not landed if it may, and its result is settled (checkpointed, or kept on disk by the
executors) before the next one looks at it, so nothing is parsed, unzipped or asked for twice. No
row can stop the job: every error is a value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.ids import article_urls, doi_error, normalize_doi, paper_paths, with_route
from ..operators import audit, blocks, jats, markdown_clean, metadata, publisher_xml
from ..operators.manifest import RECOVERED, RECOVERY_NOTE, manifest
from ..sources import landed
from ..sources.requests import pdf_requests, requests

RESULT = (
    "doi string, priority int, ok boolean, source string, status string, fallback_used boolean, markdown string, raw_markdown string, failures array<string>, warnings array<string>,"
    " reason string, details string, files map<string,string>"
)
COLUMNS = [c.split()[0] for c in RESULT.split(", ")]
#: PDF kinds with their priority and the source they are named as, by route.
PDF_KINDS = {
    "nature": {"explicit_pdf": (1, "local_pdf_mineru"), "local_pdf": (3, "local_pdf_mineru"), "public_pdf": (4, "nature_pdf_mineru")},
    "building_simulation": {"explicit_pdf": (1, "local_pdf_mineru"), "local_pdf": (3, "local_pdf_mineru"), "public_pdf": (4, "building_simulation_pdf_mineru")},
}
NUMBERED_AT_ONCE = 65_536


@dataclass
class Options:
    """root: the library's folder. page_counter: pages of PDF bytes. unzip: the content JSON of an archive's bytes and an error.
    parser: PDF bytes to content JSON, for PDFs without landed content. fetch: a request table to its answers, see sources.http."""

    root: str = "workspace/library"
    page_counter: Callable = landed.count_pages
    unzip: Callable = landed.member_of
    parser: Callable | None = None
    fetch: Callable[[DataFrame], DataFrame] | None = None


#: What is kept on the executors' disks for a run.
HELD: list[DataFrame] = []


def release(down_to: int = 0) -> None:
    """Give up what has been kept since there were so many."""
    while len(HELD) > down_to:
        HELD.pop().unpersist()


def settled(df: DataFrame) -> DataFrame:
    """df computed once: a checkpoint in the shared folder, or kept on the executors' disks where no such folder is set."""
    context = df.sparkSession.sparkContext
    if folder := context.getConf().get("spark.checkpoint.dir"):
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return df.checkpoint()
    HELD.append(df.persist(StorageLevel.DISK_ONLY))
    return HELD[-1]


def _none() -> Column:
    return F.array().cast("array<string>")


def _shape(df: DataFrame, **values: Column | str) -> DataFrame:
    """The columns of RESULT; what is not given is null."""
    types = dict(c.split() for c in RESULT.split(", "))
    defaults = {"ok": F.col("status") != "failed", "failures": _none(), "warnings": _none(), "fallback_used": F.lit(False)}
    made = {}
    for c in COLUMNS:
        v = values.get(c, defaults.get(c, F.lit(None)) if c not in ("doi", "status") else c)
        made[c] = F.col(v) if isinstance(v, str) else v
    return df.withColumn("status", made.pop("status")).select(*[(F.col("status") if c == "status" else made[c]).cast(types[c]).alias(c) for c in COLUMNS])


def _failed(df: DataFrame, priority: Column, source: Column, code: Column, reason: Column, fallback: bool = False) -> DataFrame:
    return _shape(df, priority=priority, source=source, status=F.lit("failed"), failures=F.array(code), reason=reason, fallback_used=F.lit(fallback))


def numbered(dois: DataFrame, pos: str = "pos") -> DataFrame:
    """Adds index, from 1 in the order of pos: a running number inside each stretch of places, and what the stretches before hold."""
    own = dois.withColumn("__at", F.floor(F.col(pos) / NUMBERED_AT_ONCE))
    sizes = own.groupBy("__at").agg(F.count("*").alias("__n"))
    # One row a stretch.
    before = sizes.select("__at", (F.sum("__n").over(Window.orderBy("__at")) - F.col("__n")).alias("__before"))
    local = F.row_number().over(Window.partitionBy("__at").orderBy(pos))
    return own.withColumn("__local", local).join(F.broadcast(before), "__at").withColumn("index", (F.col("__before") + F.col("__local")).cast("long")).drop("__at", "__local", "__before")


def work(dois: DataFrame) -> DataFrame:
    """(pos, doi_raw) with doi, doi_error, publisher, route and supported."""
    return with_route(dois.withColumn("doi", normalize_doi("doi_raw")).withColumn("doi_error", doi_error("doi_raw")))


# Routes. Each takes the artifacts of papers that are still open.


def publisher_route(own: DataFrame) -> DataFrame:
    """(doi, content) of publisher XML."""
    seen = settled(publisher_xml.read_publisher_xml(own.select("doi", "content"), "content").drop("content"))
    full = publisher_xml.missing_tables(markdown_clean.clean(seen.where("is_full_text")))
    stats = F.struct("section_count", "paragraph_count", "reference_count", "text_characters", "table_count_markdown", "reference_count_markdown", "display_equations_removed", "remaining_display_math", F.col("relocated").alias("relocated_tables"), "missing_float_table_ids", "image_only_float_table_ids", "expectation")
    done = _shape(audit.publisher_gate(full), priority=F.lit(1), source=F.lit("elsevier_xml"), markdown="llm_markdown", raw_markdown="raw_markdown", failures="failures", warnings="warnings", details=F.to_json(stats))
    thin = seen.where(~F.col("is_full_text"))
    return done.unionByName(_failed(thin, F.lit(1), F.lit("elsevier_xml"), F.lit("elsevier_xml_not_full_text"), F.coalesce("xml_error", "reason")))


def jats_route(own: DataFrame) -> DataFrame:
    """(doi, content) of JATS articles; whatever speaks against one sends the paper to its next source."""
    seen = jats.read_jats(own.select("doi", "content"), "content").select("doi", "error", "stats", "stats.reference_count", "stats.table_count", "stats.candidate_full_text", "cells", "markdown", "render_error")
    tokens = F.flatten(F.transform("cells", audit.structured_numbers))
    checked = audit.jats_gate(seen.withColumn("values_match", tokens == audit.markdown_numbers("markdown")))
    reason = (
        F.when(F.col("error").isNotNull(), "jats_validation_failed").when(~F.col("candidate_full_text"), "jats_not_full_text")
        .when(F.col("render_error").isNotNull(), "jats_render_failed").otherwise(F.col("fallback_reason"))
    )
    out = checked.withColumn("why", reason)
    return _shape(out, ok=F.col("why").isNull(), priority=F.lit(2), source=F.lit("springer_nature_jats"), markdown="markdown", raw_markdown="markdown", failures="failures", warnings="warnings", reason="why", details=F.to_json("stats"))


def pdf_choice(pdfs: DataFrame, options: Options) -> tuple[DataFrame, DataFrame]:
    """PDFs (doi, route, kind, content) to the one to parse per paper (doi, route, kind, priority, source) and the failures."""
    rank, name = F.lit(None).cast("int"), F.lit(None).cast("string")
    for route, kinds in PDF_KINDS.items():
        for kind, (priority, source) in kinds.items():
            own = (F.col("route") == route) & (F.col("kind") == kind)
            rank, name = F.when(own, priority).otherwise(rank), F.when(own, source).otherwise(name)
    counted = landed.with_page_count(pdfs, "content", options.page_counter)
    state = audit.pdf_state(counted.withColumns({"expected_pages": F.lit(None).cast("long"), "expected_bytes": F.lit(None).cast("long")}))
    state = state.select("doi", "route", "kind", rank.alias("priority"), name.alias("source"), "pdf_status", "actual_pages", "actual_bytes", "pdf_acceptable")
    state = settled(state)
    several = state.groupBy("doi", "kind").agg(F.count("*").alias("n"))
    rows = state.join(several, ["doi", "kind"])
    alone = F.col("n") == 1
    good = rows.where(alone & F.col("pdf_acceptable"))
    best = good.groupBy("doi").agg(F.min_by(F.struct("route", "kind", "priority", "source", "pdf_status", "actual_pages", "actual_bytes"), "priority").alias("x")).select("doi", "x.*")
    bad = rows.where(~(alone & F.col("pdf_acceptable"))).dropDuplicates(["doi", "kind"])
    why = F.when(alone, "pdf_not_parseable").otherwise("multiple_local_pdf")
    return best, _failed(bad, F.col("priority"), F.col("source"), why, F.when(alone, F.col("pdf_status")).otherwise("multiple_local_pdf"))


def content_route(pdfs: DataFrame, artifacts: DataFrame, options: Options) -> DataFrame:
    """PDFs (doi, route, kind, content): bytes checked, the chosen one's content read once, rendered, audited and gated."""
    best, failures = pdf_choice(pdfs, options)
    best = settled(best)
    of = lambda kind: artifacts.where(F.col("kind") == kind).select("doi", "content").join(best.select("doi"), "doi", "left_semi")
    zips = landed.read_content_zips(of("content_zip"), unzip=options.unzip).select("doi", "content_json", F.col("zip_error").alias("content_error"))
    plain = of("content_json").select("doi", F.col("content").cast("string").alias("content_json"), F.lit(None).cast("string").alias("content_error"))
    have = zips.unionByName(plain)
    if options.parser is not None:
        have = settled(have)
        open_ = best.join(have.select("doi"), "doi", "left_anti").select("doi", "kind")
        parsed = landed.parse_pdfs(pdfs.select("doi", "kind", "content").join(open_, ["doi", "kind"]), options.parser)
        have = have.unionByName(parsed.select("doi", "content_json", F.concat(F.lit("parser: "), "parser_error").alias("content_error")))
    # Of several contents for a paper a readable one counts.
    one = have.groupBy("doi").agg(F.min_by(F.struct("content_json", "content_error"), F.col("content_json").isNull()).alias("c")).select("doi", "c.*")
    both = best.join(one, "doi", "left").withColumn("content", blocks.parse_content("content_json"))
    both = settled(both)
    fallback = F.col("route") == "nature"
    good = both.where("content.pages is not null").withColumn("is_full_document", F.col("content.is_full_document"))
    rendered = blocks.render(good).withColumn("source_tables", blocks.source_tables("blocks"))
    gated = audit.content_gate(audit.content_audit(rendered))
    details = F.to_json(F.struct(F.struct("pdf_status", "actual_pages", "actual_bytes").alias("pdf"), render_stats().alias("render"), audit_stats().alias("audit"), "is_full_document"))
    files = F.create_map(F.lit("structured_content.json"), F.to_json(F.try_parse_json("content_json"), {"pretty": "true"}))
    done = _shape(gated, priority="priority", source="source", fallback_used=fallback, markdown="markdown", failures="failures", warnings="warnings", details=details, files=files)
    bad = _failed(both.where("content.pages is null"), F.col("priority"), F.col("source"), F.coalesce("content_error", F.lit("content_invalid")), F.coalesce("content_error", F.lit("content_invalid")))
    return done.unionByName(bad).unionByName(failures)


def render_stats() -> Column:
    return F.struct("page_count", "block_counts", "table_count", "image_count", "chart_count", "display_equations_removed", "references_present", "unknown_block_types")


def audit_stats() -> Column:
    return F.struct("source_table_count", "matched_table_count", "source_numeric_tokens", "final_numeric_tokens", "table_content_exact_match", "table_numeric_values_match", "has_references", "remaining_images", "remaining_base64", "remaining_display_equations", "private_use_characters", "mojibake")


def sources_used(partial: Column | str, payload: Column | str) -> Column:
    """What a partial paper was put together from. Names are fixed values."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.array_compact(F.array(F.when(c(partial).isNotNull(), "partial_jats_xml"), F.when(c(payload).isNotNull(), "springer_meta_v2")))


def restricted_route(own: DataFrame, meta: DataFrame, xml: DataFrame, options: Options) -> DataFrame:
    """Papers (doi, route) without accessible text: what metadata answers (doi, payload) and partial XML (doi, xml) tell, and the bundle of files that keeps it."""
    rows = metadata.select_record(own.join(meta, "doi", "left").join(xml, "doi", "left"))
    rows = metadata.meta_fields(metadata.read_partial(rows), name="meta")
    rows = paper_paths(rows.withColumn("fields", metadata.merge_fields("partial", "meta")), options.root)
    rerun = F.concat(F.lit("process "), F.col("doi"), F.lit(f' --library-root "{options.root}"'))
    safe = F.when(F.col("record").isNotNull(), metadata.safe_artifact("payload", "record"))
    out = rows.withColumns({"markdown": metadata.partial_markdown("doi", "fields", "directory", rerun), "safe": safe, "used": sources_used("partial", "record"), "available": metadata.available_fields("fields")})
    place = lambda name, there: F.when(there.isNotNull(), F.concat_ws("/", "directory", F.lit(name)))
    access = F.struct(
        "doi", "route", F.lit("restricted_access").alias("status"), F.lit(False).alias("full_text_available"), F.lit("full_text_not_accessible").alias("reason"), F.col("used").alias("sources_used"),
        F.col("available").alias("available_fields"), place("paper.jats.xml", F.col("partial")).alias("partial_xml"), place("springer_meta.json", F.col("safe")).alias("metadata_json"), "metadata_error",
        F.col("directory").alias("pdf_directory"), F.lit("Place exactly one PDF file in this directory. The filename may be arbitrary.").alias("pdf_filename_rule"), rerun.alias("rerun_command"),
    )
    text = F.to_json(access, {"pretty": "true", "ignoreNullFields": "false"})
    files = F.map_filter(F.create_map(F.lit("access.json"), text, F.lit("springer_meta.json"), F.col("safe")), lambda _, v: v.isNotNull())
    warnings = F.array_compact(F.array(F.lit("full_text_not_accessible"), F.lit("partial_metadata_only"), F.when(F.col("metadata_error").isNotNull() & F.col("partial").isNotNull(), "metadata_unavailable")))
    return _shape(out, priority=F.lit(9), source=F.lit("springer_restricted_partial"), status=F.lit("warning"), fallback_used=F.lit(True), markdown="markdown", raw_markdown="markdown", warnings=warnings, reason="metadata_error", details=F.to_json(access), files=files)


@F.arrow_udf(StringType())
def merged_access(old: pa.Array, new: pa.Array) -> pa.Array:
    """The access log as JSON with the entries of `new` laid over it; an unreadable one counts as empty."""
    import json

    def one(a: str | None, b: str) -> str:
        try:
            held = json.loads(a or "")
        except ValueError:
            held = None
        return json.dumps((held if isinstance(held, dict) else {}) | json.loads(b), ensure_ascii=False, indent=2)

    return pa.array([one(a, b) for a, b in zip(old.to_pylist(), new.to_pylist(), strict=True)], pa.string())


@dataclass
class Batch:
    """One run over a work list (pos, doi_raw) and landed artifacts (doi, kind, content)."""

    dois: DataFrame
    artifacts: DataFrame
    options: Options = field(default_factory=Options)
    fetched: list[DataFrame] = field(default_factory=list)
    problems: list[DataFrame] = field(default_factory=list)
    parts: list[DataFrame] = field(default_factory=list)

    def landed(self, kind: str, papers: DataFrame) -> DataFrame:
        """(doi, route, kind, content) of a kind for these papers."""
        return self.artifacts.where(F.col("kind") == kind).select("doi", "kind", "content").join(papers.select("doi", "route"), "doi")

    def asked(self, wanted: DataFrame, papers: DataFrame, priority: int, source: str, failure: str | None) -> DataFrame:
        """Answers to requests. Errors become failures of the source, or are left out where none is named."""
        got = settled(self.options.fetch(wanted))
        good = got.where("error is null").join(papers.select("doi", "route"), "doi").select("doi", "route", "kind", "content", "page_url")
        self.fetched.append(good)
        if failure:
            bad = got.where("error is not null")
            self.problems.append(_failed(bad, F.lit(priority), F.lit(source), F.lit(failure), F.col("error")))
        return good

    def available(self, kind: str, papers: DataFrame, priority: int = 9, source: str = "", failure: str | None = None) -> DataFrame:
        """Landed artifacts, and fetched ones for papers that have none."""
        here = self.landed(kind, papers)
        if self.options.fetch is None:
            return here.select("doi", "route", "kind", "content")
        open_ = papers.join(here.select("doi"), "doi", "left_anti")
        return here.select("doi", "route", "kind", "content").unionByName(self.asked(requests(open_, kind), open_, priority, source, failure).drop("page_url"))

    def open(self, papers: DataFrame) -> DataFrame:
        """Papers that no part has a usable result for."""
        for p in self.parts:
            papers = papers.join(p.where("ok").select("doi"), "doi", "left_anti")
        return papers

    def add(self, part: DataFrame) -> None:
        self.parts.append(settled(part))

    def jats(self, papers: DataFrame) -> DataFrame:
        """Landed articles, and those of fetched responses that hold the paper's."""
        here = self.landed("jats_xml", papers).select("doi", "content")
        if self.options.fetch is None:
            return here
        open_ = papers.join(here.select("doi"), "doi", "left_anti")
        answers = self.asked(requests(open_, "oa_response"), open_, 2, "springer_nature_jats", "jats_unavailable")
        picked = settled(jats.pick_articles(answers.select("doi", F.col("content").alias("response_xml"))))
        found = picked.where("article_xml is not null").select("doi", F.col("article_xml").cast("binary").alias("content"))
        self.fetched.append(found.select("doi", F.lit("nature").alias("route"), F.lit("jats_xml").alias("kind"), "content", F.lit(None).cast("string").alias("page_url")))
        self.problems.append(_failed(picked.where("article_xml is null"), F.lit(2), F.lit("springer_nature_jats"), F.lit("jats_unavailable"), F.concat(F.lit("articles in the response: "), "article_count")))
        return here.unionByName(found)

    def public_pdfs(self, papers: DataFrame) -> DataFrame:
        """Landed PDFs of the publisher's page, and fetched ones: the page, its main link, the file."""
        here = self.landed("public_pdf", papers)
        # A landed page takes the place of a fetched one.
        if self.options.fetch is None:
            return here.select("doi", "route", "kind", "content")
        open_ = papers.join(here.select("doi"), "doi", "left_anti")
        pages = self.landed("article_html", open_).withColumn("page_url", F.lit(None).cast("string"))
        ask = open_.join(pages.select("doi"), "doi", "left_anti")
        pages = pages.select("doi", "route", "content", "page_url").unionByName(self.asked(requests(ask, "article_html"), ask, 4, "public_pdf", "article_page_unavailable").select("doi", "route", "content", "page_url"))
        html = article_urls(pages).select("doi", "route", F.col("content").cast("string").alias("html"), F.coalesce("page_url", "article_url").alias("page_url"))
        got = self.asked(pdf_requests(html), open_, 4, "public_pdf", "article_pdf_unavailable").drop("page_url")
        return here.select("doi", "route", "kind", "content").unionByName(got)

    def run(self) -> DataFrame:
        """One row per work-list entry: index, doi, route, source, status, fallback_used, markdown, raw_markdown, failures, warnings, details, files, error."""
        o = self.options
        papers = settled(numbered(work(self.dois)))
        valid = papers.where("supported").select("doi", "route").distinct()
        publisher = valid.where("route = 'elsevier'")
        by_pdf = valid.where(F.col("route").isin(*PDF_KINDS))
        self.add(publisher_route(self.available("publisher_xml", publisher, 1, "elsevier_xml", "elsevier_xml_unavailable")))
        # A PDF that was named explicitly comes before anything else.
        explicit = self.landed("explicit_pdf", by_pdf).select("doi", "route", "kind", "content")
        self.add(content_route(explicit, self.artifacts, o))
        tried = explicit.select("doi").distinct()
        self.add(jats_route(self.jats(self.open(by_pdf.where("route = 'nature'")))))
        local = self.landed("local_pdf", self.open(by_pdf).join(tried, "doi", "left_anti")).select("doi", "route", "kind", "content")
        self.add(content_route(local, self.artifacts, o))
        rest = self.open(by_pdf).join(tried, "doi", "left_anti").join(local.select("doi"), "doi", "left_anti")
        self.add(content_route(self.public_pdfs(rest), self.artifacts, o))
        none = self.open(by_pdf)
        meta = self.available("metadata_json", none).select("doi", F.col("content").cast("string").alias("payload"))
        fetched = [f.where("kind = 'jats_xml'").select("doi", F.col("content").alias("xml")) for f in self.fetched]
        xml = reduce(DataFrame.unionByName, [self.landed("jats_xml", none).select("doi", F.col("content").alias("xml")), *fetched])
        self.add(restricted_route(none, meta, xml, o))
        return self._joined(papers, reduce(DataFrame.unionByName, [*self.parts, *self.problems]))

    def _joined(self, papers: DataFrame, candidates: DataFrame) -> DataFrame:
        """Papers with their best candidate, as choose_source takes it: decided on narrow rows, texts pass by and are never sorted."""
        usable = candidates.where("ok")
        per = usable.groupBy("doi", "priority").agg(F.count("*").alias("n"))
        best = per.groupBy("doi").agg(F.min(F.struct("priority", "n")).alias("best")).select("doi", "best.*")
        failed = candidates.where(~F.col("ok")).groupBy("doi").agg(F.min_by(F.struct("source", "failures", "reason"), "priority").alias("bad"))
        rows = papers.select("index", "doi_raw", "doi", "doi_error", "route", "supported")
        known = rows.where("doi is not null").join(best, "doi", "left").join(failed, "doi", "left")
        both = known.hint("shuffle_hash").join(usable.drop("ok", "reason"), ["doi", "priority"], "left")
        # Of several usable ones of a source any one counts.
        out = both.where("n is null or n = 1").unionByName(both.where("n > 1").dropDuplicates(["index"])).unionByName(rows.where("doi is null"), allowMissingColumns=True)
        error = (
            F.when(F.col("doi_error").isNotNull(), F.concat(F.lit("invalid DOI: "), "doi_error")).when(~F.col("supported"), "unsupported route")
            .when(F.col("source").isNull(), F.concat(F.lit("no usable source: "), F.coalesce(F.nullif(F.array_join("bad.failures", ", "), F.lit("")), F.col("bad.reason"), F.lit("none landed"))))
        )
        return out.withColumns({"error": error, "fallback_reason": F.coalesce(F.col("bad.reason"), F.array_join("bad.failures", ", "))}).withColumn("doi", F.coalesce("doi", "doi_raw")).drop("bad", "priority", "n", "doi_raw", "doi_error", "supported")

    def recovered(self, results: DataFrame) -> DataFrame:
        """(paper_id, name, data): access logs of papers that a PDF has recovered since."""
        logs = self.artifacts.where("kind = 'access_json'").select("doi", F.col("content").cast("string").alias("old"))
        new = F.to_json(F.struct("doi", F.lit(RECOVERED).alias("status"), F.lit(True).alias("full_text_available"), F.col("source").alias("recovered_source"), F.concat_ws("/", "directory", F.lit("paper.pdf")).alias("recovered_pdf"), F.lit(RECOVERY_NOTE).alias("recovery_note")))
        done = paper_paths(results.where("error is null and source like '%pdf_mineru'"), self.options.root).join(logs, "doi")
        return done.select("paper_id", F.lit("access.json").alias("name"), merged_access("old", new).cast("binary").alias("data"))


def process(dois: DataFrame, artifacts: DataFrame, options: Options | None = None) -> DataFrame:
    """One row per work-list entry, see Batch.run."""
    return Batch(dois, artifacts, options or Options()).run()


def batch_manifest(results: DataFrame, options: Options | None = None) -> DataFrame:
    """The manifest of processed papers, with the paths their files have."""
    options = options or Options()
    rows = paper_paths(results, options.root).withColumns({"llm_markdown": F.when(F.col("markdown").isNotNull(), F.col("llm_md")), "qa": F.col("qa_json")})
    return manifest(rows)


def qa_json(results: DataFrame) -> DataFrame:
    """(doi, qa): the QA document of each paper, failed ones too."""
    details = [F.try_parse_json("details").alias("details")] if "details" in results.columns else []
    reason = [F.when(F.col("fallback_used"), F.col("fallback_reason")).alias("fallback_reason")] if "fallback_reason" in results.columns else []
    fields = F.struct("doi", "route", "source", F.when(F.col("error").isNotNull(), "failed").otherwise(F.col("status")).alias("status"), "fallback_used", *reason, "warnings", "failures", "error", *details)
    return results.select("doi", F.to_json(fields, {"pretty": "true", "ignoreNullFields": "false"}).alias("qa"))


__all__ = ["Batch", "Options", "batch_manifest", "process", "qa_json"]
