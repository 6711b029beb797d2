"""Records to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import stable_hash, strip, strip_html, strip_wikitext
from textmill.schema import DOC

# Other names of the eight domains.
DOMAIN_ALIASES = {
    "code": "code_docs", "the_stack_v2": "code_docs", "the-stack": "code_docs", "stack": "code_docs", "wiki": "reference", "wikipedia": "reference", "encyclopedia": "reference", "books": "books_longform",
    "longform": "books_longform", "web": "filtered_web", "filteredweb": "filtered_web", "papers": "paper_teasers", "paper": "paper_teasers", "paper_preview": "paper_teasers", "tutorials": "tutorials_notebooks", "notebooks": "tutorials_notebooks",
}


def _field(df: DataFrame, path: str) -> Column:
    """A column or nested field as a string, null where the frame has none."""
    top, _, rest = path.partition(".")
    if top not in df.columns:
        return F.lit(None).cast("string")
    kind = df.schema[top].dataType
    if rest and rest not in getattr(kind, "names", []):
        return F.lit(None).cast("string")
    return F.col(path).cast("string")


def _some(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def _tree(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("map<string,string>") if name in df.columns else F.create_map().cast("map<string,string>")


def question_text(title: Column, body: Column, answer: Column) -> Column:
    part = lambda c: F.coalesce(c, F.lit(""))
    return strip(F.concat(F.lit("Q: "), part(title), F.lit("\n"), part(body), F.lit("\nA: "), part(answer)))


def normalise(records: DataFrame, domain: str, source: str, license_tag: str | None = None) -> DataFrame:
    """Documents from records of any of the known shapes: text or content, or question and answer; ids, dates and licences under
    their several names; title, url, tags and language into meta. Domain and source come from the arguments."""
    text = _some(_field(records, "text"), _field(records, "content"))
    if "question" in records.columns:
        text = F.coalesce(
            text,
            F.when(
                F.col("question").isNotNull(),
                question_text(_field(records, "question.title"), _field(records, "question.body"), _field(records, "answer.body"))
            )
        )
    meta = F.coalesce(_tree(records, "meta"), F.create_map().cast("map<string,string>"))
    for key, path in (("title", "title"), ("url", "url"), ("tags", "tags"), ("language", "language"), ("tags", "question.tags")):
        value = _field(records, path)
        meta = F.when(
            value.isNotNull() & ~F.map_contains_key(meta, key), F.map_concat(meta, F.create_map(F.lit(key), value))
        ).otherwise(meta)
    base = records.select(
        F.coalesce(text, F.lit("")).alias("text"), F.lit(source).alias("source"), F.lit(domain).alias("domain"), _some(
            _field(records, "doc_id"), _field(records, "id")
        ).alias("doc_id"),
        _some(_field(records, "license_tag"), _field(records, "license"), F.lit(license_tag).cast("string")).alias("license_tag"),
        _some(
            *[_field(records, x) for x in ("created_at", "timestamp", "creation_date", "question.creation_date")]
        ).alias("created_at"), F.when(F.size(meta) > 0, meta).alias("meta"),
        *[c for c in ("ord",) if c in records.columns],
    )
    return base.withColumn("doc_id", F.coalesce("doc_id", stable_hash(F.concat(F.lit(f"{source}::"), F.col("text")))))


def truncate(docs: DataFrame, chars: int) -> DataFrame:
    return docs.withColumn("text", F.substring("text", 1, chars))


def chunk(docs: DataFrame, chars: int, overlap: int = 0) -> DataFrame:
    """Rows of `chars` characters, each from `chars - overlap` on after the last, with ids doc_id::chunk0 and so on; none for no text."""
    if not 0 <= overlap < chars:
        raise ValueError("overlap has to be less than chars, and 0 at least")
    step = chars - overlap
    starts = F.when(F.length("text") > 0, F.sequence(F.lit(0), F.length("text") - 1, F.lit(step)))
    out = docs.select("*", F.posexplode(starts).alias("chunk_index", "chunk_start"))
    out = out.withColumns(
        {
            "text": F.substring(F.col("text"), F.col("chunk_start") + 1, F.lit(chars)),
            "doc_id": F.concat(F.col("doc_id").cast("string"), F.lit("::chunk"), F.col("chunk_index").cast("string")),
            "chunk_overlap": F.lit(overlap)
        }
    )
    if "meta" in docs.columns:
        extra = F.create_map(*[x for k in ("chunk_index", "chunk_start", "chunk_overlap") for x in (F.lit(k), F.col(k).cast("string"))])
        out = out.withColumn(
            "meta", F.map_concat(F.coalesce("meta", F.create_map().cast("map<string,string>")), extra)
        ).drop("chunk_index", "chunk_start", "chunk_overlap")
    return out


def canonical_domain(c, unknown: bool = False) -> Column:
    """The domain an alias stands for. With `unknown`, names that are no domain go by their beginning, else to filtered_web."""
    c = F.trim(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))
    named = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in DOMAIN_ALIASES.items() for x in kv]), c), c)
    if not unknown:
        return named
    from textmill.operators.mix import BASE_WEIGHTS

    return F.when(named.isin(list(BASE_WEIGHTS)), named).when(
        named.startswith("books"), "books_longform"
    ).when(named.startswith("paper"), "paper_teasers").otherwise("filtered_web")


def wikipedia(pages: DataFrame, domain: str = "reference", source: str = "wikipedia", license_tag: str = "CC-BY-SA") -> DataFrame:
    """Documents from extracted articles (id, title, text): the title above the text."""
    title, body = (F.coalesce(_field(pages, x), F.lit("")) for x in ("title", "text"))
    text = F.when((title != "") & (body != ""), F.concat(title, F.lit("\n\n"), body)).otherwise(body)
    made = pages.select(
        text.alias("text"), title.alias("title"), _some(_field(pages, "id"), _field(pages, "doc_id")).alias("doc_id"),
        _some(_field(pages, "created_at"), _field(pages, "timestamp")).alias("created_at")
    )
    return made.select(
        "text", F.lit(source).alias("source"), F.lit(domain).alias("domain"),
        F.coalesce("doc_id", stable_hash(F.concat_ws(":", F.lit(source), "title", "text"))).alias("doc_id"),
        F.lit(license_tag).alias("license_tag"), "created_at",
        F.when(F.col("title") != "", F.create_map(F.lit("title"), F.col("title"))).alias("meta")
    )


def wiki_dump(pages: DataFrame) -> DataFrame:
    """(id, title, timestamp, text) of the articles, name space 0, of dump pages (ns, id, title, revision)."""
    revision = lambda x: F.coalesce(F.col(f"revision.{x}").cast("string"), F.lit(""))
    return pages.where(F.col("ns").cast("string") == "0").select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), F.coalesce("title", F.lit("")).alias("title"),
        revision("timestamp").alias("timestamp"), strip_wikitext(revision("text")).alias("text")
    )


def stackexchange(
    posts: DataFrame, domain: str = "forums_qa", source: str = "stackexchange", limit: int | None = None, accepted: bool = True
) -> DataFrame:
    """A document per question of posts (Id, PostTypeId, ParentId, AcceptedAnswerId, Title, Body, Tags, CreationDate, Score, ord):
    its accepted answer, looked up among all answers, else that of the highest score, the first of equals, else none."""
    p = posts.select(
        *[_field(posts, c).alias(c) for c in ("Id", "PostTypeId", "ParentId", "AcceptedAnswerId", "Title", "Body", "Tags", "CreationDate")],
        F.coalesce(_field(posts, "Score").cast("int"), F.lit(0)).alias("Score"), "ord"
    )
    answers = p.where((F.col("PostTypeId") == "2") & F.col("ParentId").isNotNull()).select(
        "Id", "ParentId", "Score", "ord", strip_html("Body").alias("body")
    )
    best = answers.groupBy("ParentId").agg(F.max_by("body", F.struct("Score", -F.col("ord"))).alias("best"))
    questions = p.where((F.col("PostTypeId") == "1") & F.col("Id").isNotNull())
    latest = questions.groupBy("Id").agg(
        F.max_by(F.struct("AcceptedAnswerId", "Title", "Body", "Tags", "CreationDate"), "ord").alias("q"), F.min("ord").alias("ord")
    ).select("Id", "ord", "q.*")
    if limit is not None:
        latest = latest.orderBy("ord").limit(limit)
    out = latest.join(best, latest["Id"] == best["ParentId"], "left")
    answer = F.col("best")
    if accepted:
        by_id = answers.groupBy(F.col("Id").alias("answer_id")).agg(F.max_by("body", "ord").alias("taken"))
        out = out.join(by_id, out["AcceptedAnswerId"] == by_id["answer_id"], "left")
        answer = F.coalesce("taken", "best")
    text = question_text(F.col("Title"), strip_html("Body"), answer)
    return out.select(
        text.alias("text"), F.lit(source).alias("source"), F.lit(domain).alias("domain"), F.col("Id").alias("doc_id"),
        F.lit(None).cast("string").alias("license_tag"), F.col("CreationDate").alias("created_at"),
        F.create_map(F.lit("tags"), F.coalesce("Tags", F.lit(""))).alias("meta")
    )


def stackexchange_raw(posts: DataFrame) -> DataFrame:
    """(id, question, answer) structs instead of documents; the best answer alone counts."""
    d = posts.where(
        (_field(posts, "PostTypeId") == "2") & F.col("ParentId").isNotNull()
    ).groupBy(F.col("ParentId").cast("string").alias("parent")).agg(
        F.max_by(strip_html(F.col("Body")), F.struct(F.coalesce(F.col("Score").cast("int"), F.lit(0)), -F.col("ord"))).alias("body")
    )
    q = posts.where(_field(posts, "PostTypeId") == "1")
    question = F.struct(
        F.coalesce(_field(q, "Title"), F.lit("")).alias("title"), strip_html("Body").alias("body"),
        F.coalesce(_field(q, "Tags"), F.lit("")).alias("tags"), F.coalesce(_field(q, "CreationDate"), F.lit("")).alias("creation_date")
    )
    return q.select(
        F.col("Id").cast("string").alias("id"), question.alias("question")
    ).join(d, F.col("id") == F.col("parent"), "left").select(
        "id", "question", F.struct(F.coalesce("body", F.lit("")).alias("body")).alias("answer")
    )


def to_json(docs: DataFrame) -> DataFrame:
    """One column `value` of JSON with all seven keys."""
    return docs.select(
        F.to_json(
            F.struct(*[F.col(f.name) if f.name in docs.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in DOC]),
            {"ignoreNullFields": "false"}
        ).alias("value")
    )
