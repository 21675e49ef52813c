"""Text cleaning, corpus statistics, TF-IDF, retrieval and batch generation over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalis.functions import scalars
from vitalis.functions import text as tx
from vitalis.operators import retrieval, textprep
from vitalis.operators.vectors import COMPACT
from vitalis.plans.core_queries import rounded
from vitalis.plans.frames import LABELLED_SQL, LINE_KEY_SQL, keyed_lines, labelled_documents
from vitalis.plans.registry import query, table
from vitalis.session import durable, spread

# fixed values: the stop words of the registered TF-IDF queries
STOP_WORDS = ("the", "and", "of", "to", "in", "is", "it", "that", "for", "on", "are", "was", "with", "as", "at", "by")
# fixed values: nouns whose base form no ending rule gives
NOUN_EXCEPTIONS = {"children": "child", "feet": "foot", "mice": "mouse", "teeth": "tooth", "des": "de", "les": "le"}
TEMPLATE = "Answer the question in plain words.\nQuestion: {question}\nPassages: {passages}\nReply:"


def _docs(spark, d):
    return spread(table(spark, d, "documents").select("doc_id", "text"))


@query(
    "str_split_path",
    r"""
    select page_id, string_split(url, '/')[3] as host, regexp_replace(regexp_replace(url, '^.*/', ''), '(.)\.[^.]*$', '\1') as stem,
           string_split(url, '/')[-2] as parent from pages
    """,
)
def str_split_path(spark, d):
    return table(spark, d, "pages").select(
        "page_id", tx.split_field("url", "/", 3).alias("host"), tx.file_stem("url").alias("stem"), tx.parent_name("url").alias("parent")
    )


_CLEAN_SQL = (
    r"lower(regexp_replace(regexp_replace({c}, '[!-/:-@\[-`{{-~]', '', 'g'), "
    r"'[\p{{Nd}}\x{{B2}}\x{{B3}}\x{{B9}}\x{{2070}}\x{{2074}}-\x{{2079}}\x{{2080}}-\x{{2089}}]', '', 'g'))"
)


@query("clean_text", f"select doc_id, {_CLEAN_SQL.format(c='text')} as text from documents")
def clean_text(spark, d):
    return _docs(spark, d).select("doc_id", tx.clean_text("text").alias("text"))


_SENTENCES_SQL = (
    r"list_filter(string_split(regexp_replace(text, '([.!?])[ \t\n\f\r]+', '\1' || chr(1), 'g'), chr(1)), "
    "lambda s: length(trim(s)) > 0)"
)


@query(
    "sentence_split",
    f"select doc_id, s as position, list[s + 1] as sentence from (select doc_id, list, unnest(range(len(list))) as s from (select doc_id, {_SENTENCES_SQL} as list from documents))",
)
def sentence_split(spark, d):
    split = _docs(spark, d).select("doc_id", F.posexplode(tx.sentences("text")).alias("position", "sentence"))
    return split.withColumn("position", F.col("position").cast("bigint"))


_WORDS = r"'[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\f\r]'"


@query(
    "word_tokenize",
    f"select doc_id, len(w) as n_tokens, array_to_string(w, ' ') as tokens from (select doc_id, regexp_extract_all(text, {_WORDS}) as w from documents)",
)
def word_tokenize(spark, d):
    return _docs(spark, d).select("doc_id", tx.words("text").alias("w")).select(
        "doc_id", F.size("w").cast("bigint").alias("n_tokens"), F.array_join("w", " ").alias("tokens")
    )


@query(
    "edge_sentences",
    f"""
    select doc_id, array_to_string(list_concat(list[1:1], case when len(list) >= 2 then list[greatest(len(list) - 1, 1):greatest(len(list) - 1, 1)]
      else [] end), ' ') as edges from (select doc_id, {_SENTENCES_SQL} as list from documents)
    """,
)
def edge_sentences(spark, d):
    return _docs(spark, d).select(
        "doc_id", F.array_join(tx.edge_sentences(tx.sentences("text")), " ").alias("edges")
    )


_TERMS_SQL = r"regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}_]{{2,}}')"


@query(
    "lemmatize",
    rf"""
    select doc_id, array_to_string(list_transform({_TERMS_SQL.format(c='text')}, lambda t: case
        when t = 'children' then 'child' when t = 'feet' then 'foot' when t = 'mice' then 'mouse' when t = 'teeth' then 'tooth'
        when t = 'des' then 'de' when t = 'les' then 'le' when length(t) <= 3 then t when regexp_matches(t, '(ss|us|is)$') then t
        when regexp_matches(t, 'men$') then regexp_replace(t, 'men$', 'man')
        when regexp_matches(t, '(ch|sh|x|z|ss)es$') then regexp_replace(t, 'es$', '')
        when regexp_matches(t, 'ies$') then regexp_replace(t, 'ies$', 'y')
        when regexp_matches(t, 's$') then regexp_replace(t, 's$', '') else t end), ' ') as lemmas
    from documents
    """,
)
def lemmatize(spark, d):
    lemmas = tx.lemmatize_nouns(tx.terms("text"), NOUN_EXCEPTIONS)
    return _docs(spark, d).select("doc_id", F.array_join(lemmas, " ").alias("lemmas"))


def _lexicon(spark, d):
    grams = tx.ngrams(tx.terms("text"), (1, 2, 3))
    return table(spark, d, "benchmark").select(F.explode(grams).alias("term")).distinct()


@query(
    "entity_filter",
    f"""
    with b as (select {_TERMS_SQL.format(c='text')} as t from benchmark),
    lex as (select distinct unnest(t) as term from b
            union select distinct t[i] || ' ' || t[i + 1] from (select t, unnest(range(1, len(t))) as i from b)
            union select distinct t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] from (select t, unnest(range(1, len(t) - 1)) as i from b)),
    k as (select doc_id, {_TERMS_SQL.format(c='text')} as t from documents),
    g as (select doc_id, i - 1 as p, 1 as n, t[i] as term from (select doc_id, t, unnest(range(1, len(t) + 1)) as i from k)
          union all select doc_id, i - 1, 2, t[i] || ' ' || t[i + 1] from (select doc_id, t, unnest(range(1, len(t))) as i from k)
          union all select doc_id, i - 1, 3, t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] from (select doc_id, t, unnest(range(1, len(t) - 1)) as i from k)),
    h as (select doc_id, list({{'p': p, 'e': p + n, 's': term}} order by p, n desc) as hits from g semi join lex using (term) group by doc_id),
    r as (select doc_id, list_reduce(list_prepend({{'p': 0::bigint, 'e': 0::bigint, 's': ''}}, hits), lambda acc, x:
            case when x.p >= acc.e then {{'p': x.p, 'e': x.e, 's': acc.s || ' ' || x.s}} else acc end) as last from h)
    select doc_id, coalesce(substr(last.s, 2), '') as entities from documents left join r using (doc_id)
    """,
)
def entity_filter(spark, d):
    return textprep.entity_mentions(table(spark, d, "documents"), "doc_id", "text", _lexicon(spark, d))


@query(
    "token_freq",
    f"select token, count(*) as n from (select unnest(regexp_extract_all(lower(text), {_WORDS})) as token from documents) group by token",
)
def token_freq(spark, d):
    return textprep.token_freq(table(spark, d, "documents"), "text")


@query(
    "corpus_counts",
    f"""
    select cast(sum(len({_SENTENCES_SQL})) as bigint) as n_sentences,
           (select count(distinct token) from (select unnest(regexp_extract_all(lower(text), {_WORDS})) as token from documents)) as n_words
    from documents
    """,
)
def corpus_counts(spark, d):
    return textprep.corpus_counts(table(spark, d, "documents"), "text")


@query(
    "clean_text_pipeline_frames",
    f"""
    select doc_id, array_to_string(list_transform({_TERMS_SQL.format(c=_CLEAN_SQL.format(c='text'))}, lambda t: case
        when length(t) <= 3 or regexp_matches(t, '(ss|us|is)$') then t when regexp_matches(t, 'men$') then regexp_replace(t, 'men$', 'man')
        when regexp_matches(t, '(ch|sh|x|z|ss)es$') then regexp_replace(t, 'es$', '') when regexp_matches(t, 'ies$') then regexp_replace(t, 'ies$', 'y')
        when regexp_matches(t, 's$') then regexp_replace(t, 's$', '') else t end), ' ') as text from documents
    """,
)
def clean_and_lemmatize(spark, d):
    """Text functions chained over a frame, each one an expression."""

    def cleaned(df):
        return df.withColumn("text", tx.clean_text("text"))

    def lemmatized(df):
        return df.withColumn("text", F.array_join(F.transform(tx.terms("text"), tx.noun_base), " "))

    return _docs(spark, d).select("doc_id", "text").transform(cleaned).transform(lemmatized)


@query(
    "render_prompt",
    """
    select conv_id, turn, 'Turn ' || turn || ' of ' || conv_id || ', ' || role || ':' || chr(10) || text || chr(10) || 'Topic:' as prompt
    from conversations
    """,
)
def render_prompt(spark, d):
    template = "Turn {number} of {conversation}, {speaker}:\n{said}\nTopic:"
    fields = {"number": F.col("turn").cast("string"), "conversation": F.col("conv_id").cast("string"), "speaker": "role", "said": "text"}
    return table(spark, d, "conversations").select("conv_id", "turn", tx.render_prompt(template, fields).alias("prompt"))


@query(
    "prefix_prompt",
    "select doc_id, 'summarize: ' || text as prompt from documents",
)
def prefix_prompt(spark, d):
    return _docs(spark, d).select("doc_id", tx.render_prompt("summarize: {document}", {"document": "text"}).alias("prompt"))


@query(
    "parse_float_list",
    f"""
    select row_key, cast(p - 1 as integer) as position, cast(v[p] as float) as value from
      (select {LINE_KEY_SQL} as row_key, [l_discount, l_tax] as v, unnest([1, 2]) as p from lineitem)
    """,
)
def parse_float_list(spark, d):
    response = F.concat(F.lit("b'"), F.col("l_discount").cast("string"), F.lit(","), F.col("l_tax").cast("string"), F.lit("'"))
    return keyed_lines(spark, d).select("row_key", F.posexplode(scalars.parse_float_list(response)).alias("position", "value"))


@query("encode_base64", "select doc_id, 'text/plain' as mime_type, to_base64(encode(text)) as data from documents")
def encode_base64(spark, d):
    part = scalars.data_part(F.encode("text", "UTF-8"), "text/plain")
    return table(spark, d, "documents").select("doc_id", part.alias("part")).select("doc_id", "part.mime_type", "part.data")


@query(
    "math_scalar",
    """
    select o_orderkey, round(o_totalprice * o_totalprice, 2) as squared, round(sqrt(o_totalprice), 3) as root,
           round(abs(o_totalprice - 250000), 3) as distance,
           round(greatest(o_totalprice - 250000, 0) / (select max(o_totalprice) - 250000 from orders), 6) as heat from orders
    """,
)
def math_scalar(spark, d):
    orders = table(spark, d, "orders")
    largest = orders.agg(F.max(F.col("o_totalprice") - 250000)).scalar()
    x = F.col("o_totalprice")
    return orders.select(
        "o_orderkey",
        F.round(x * x, 2).alias("squared"),
        F.round(F.sqrt(x), 3).alias("root"),
        F.round(F.abs(x - 250000), 3).alias("distance"),
        F.round(scalars.relu_share(x - 250000, largest), 6).alias("heat"),
    )


@query(
    "array_reshape",
    """
    select vec_id, r as row_no, round(list_sum(cast(embedding[r * 8 + 1:r * 8 + 8] as double[])), 5) + 0.0 as total,
           cast(len(list_filter(embedding, lambda x: x > 0.1)) as integer) as n_bright
    from (select vec_id, embedding, cast(unnest(range(8)) as integer) as r from embeddings)
    """,
)
def array_reshape(spark, d):
    rows = table(spark, d, "embeddings").select(
        "vec_id",
        scalars.masked_count("embedding", 0.1).alias("n_bright"),
        F.posexplode(scalars.reshape("embedding", 8, 8)).alias("row_no", "line"),
    )
    total = F.aggregate("line", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return rows.select("vec_id", "row_no", (F.round(total, 5) + F.lit(0.0)).alias("total"), "n_bright")


FEATURES = 1000


def _tfidf_sql(max_df: float = 0.75) -> str:
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""
    k as (select doc_id, list_filter({_TERMS_SQL.format(c='text')}, lambda t: t not in ({stops})) as t from documents),
    g as ({_grams_sql('k', 'doc_id')}),
    v as (select term, row_number() over (order by uses desc, term) - 1 as position, texts,
                 ln((1 + (select count(*) from documents)) / (1 + texts)) + 1 as idf
          from (select term, count(*) as uses, count(distinct doc_id) as texts from g group by term)
          where texts <= {max_df} * (select count(*) from documents) order by uses desc, term limit {FEATURES}),
    {_weights_sql('w', 'g', 'doc_id')}"""


def _grams_sql(source: str, key: str) -> str:
    return f"""select {key}, unnest(t) as term from {source}
    union all select {key}, t[i] || ' ' || t[i + 1] from (select {key}, t, unnest(range(1, len(t))) as i from {source})
    union all select {key}, t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] from (select {key}, t, unnest(range(1, len(t) - 1)) as i from {source})"""


def _weights_sql(name: str, grams: str, key: str) -> str:
    return f"""{name} as (select {key}, term, x / sqrt(sum(x * x) over (partition by {key})) as weight from
      (select {key}, term, count(*) * max(idf) as x from {grams} join v using (term) group by {key}, term))"""


_FITTED: dict[tuple, textprep.TfIdf] = {}


def _version(spark, d) -> tuple:
    """The application and the files of a folder's documents with their lengths and times."""
    files = table(spark, d, "documents").select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    return spark.sparkContext.applicationId, *sorted(map(tuple, files.collect()))  # a row per file


def _model(spark, d):
    """The vocabulary of a folder's documents, fitted once in an application for the same files and used by six queries."""
    key = _version(spark, d)
    if key not in _FITTED:
        _FITTED[key] = textprep.TfIdf.fit(table(spark, d, "documents"), "text", (1, 3), STOP_WORDS, 0.75, FEATURES)
    return _FITTED[key]


@query(
    "tfidf_vocab",
    f"with {_tfidf_sql()} select term, cast(position as integer) as position, texts as n_texts, round(idf, 6) as idf from v",
)
def tfidf_vocab(spark, d):
    """This one always fits anew."""
    _FITTED.pop(_version(spark, d), None)
    return rounded(_model(spark, d).vocabulary_frame(table(spark, d, "documents")), 6, "idf")


@query("tfidf_weights", f"with {_tfidf_sql()} select doc_id, term, round(weight, 6) as weight from w")
def tfidf_weights(spark, d):
    return rounded(_model(spark, d).weights(table(spark, d, "documents"), "doc_id", "text"), 6, "weight")


def _questions(spark, d):
    return (
        table(spark, d, "conversations")
        .filter("role = 'user'")
        .select(F.concat_ws("-", "conv_id", "turn").alias("query_id"), "text")
    )


def _texts(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")


def _search_sql(k: int) -> str:
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""
    {_tfidf_sql()},
    q as (select concat_ws('-', conv_id, turn) as query_id, text from conversations where role = 'user'),
    qk as (select query_id, list_filter({_TERMS_SQL.format(c='text')}, lambda t: t not in ({stops})) as t from q),
    qg as ({_grams_sql('qk', 'query_id')}),
    {_weights_sql('qw', 'qg', 'query_id')},
    s as (select query_id, doc_id, sum(qw.weight * w.weight) as score from qw join w using (term) group by 1, 2),
    p as (select query_id, doc_id, coalesce(score, 0) as score from (select distinct query_id from qw)
          join (select distinct doc_id from w) on true left join s using (query_id, doc_id)),
    hits as (select query_id, doc_id as id, score, row_number() over (partition by query_id order by round(score, 9) desc, doc_id) as rank
             from p qualify rank <= {k})"""


@query(
    "search_text",
    f"with {_search_sql(10)} select query_id, id, cast(rank as integer) as rank, round(score, 4) as score from hits",
)
def search_text(spark, d):
    hits = retrieval.search_text(_questions(spark, d), _texts(spark, d), _model(spark, d), 10)
    return rounded(hits, 4, "score")


def _context_sql() -> str:
    return f"""
    {_search_sql(4)},
    c as (select query_id, string_agg(documents.text, chr(10) || chr(10) order by rank) as context, count(*) as n_hits
          from hits join documents on id = doc_id group by query_id),
    r as (select q.query_id, q.text, context, coalesce(n_hits, 0) as n_hits from q left join c using (query_id))"""


@query("rag_context", f"with {_context_sql()} select query_id, n_hits, length(context) as n_chars, md5(context) as digest from r")
def rag_context(spark, d):
    questions, texts = _questions(spark, d), _texts(spark, d)
    hits = retrieval.search_text(questions, texts, _model(spark, d), 4)
    found = retrieval.contexts(questions, hits, texts)
    return found.select(
        "query_id", "n_hits", F.length("context").cast("bigint").alias("n_chars"), F.md5("context").alias("digest")
    )


@query(
    "rag_prompt",
    f"""
    with {_context_sql()} select query_id, case when context is null then 'No passage in the collection answers this question.' end as answer,
      md5('Answer the question in plain words.' || chr(10) || 'Question: ' || text || chr(10) || 'Passages: ' || context || chr(10) || 'Reply:') as prompt_digest
    from r
    """,
)
def rag_prompt(spark, d):
    questions, texts = _questions(spark, d), _texts(spark, d)
    hits = retrieval.search_text(questions, texts, _model(spark, d), 4)
    ready = retrieval.prompts(retrieval.contexts(questions, hits, texts), TEMPLATE)
    return ready.select("query_id", "answer", F.md5("prompt").alias("prompt_digest"))


def _longest_word(texts: list[str]) -> list[str]:
    """A stand-in model: the first of the longest blank-separated words."""
    return [max(t.split(" "), key=len) for t in texts]


@query("rag_answer")
def rag_answer(spark, d):
    """The whole flow with a stand-in model; its parts have SQL of their own."""
    return retrieval.answer(_questions(spark, d), _texts(spark, d), _model(spark, d), 4, TEMPLATE, _longest_word)


def _count_words(texts: list[str]) -> list[str]:
    return [f"{len(t.split(' '))} words, {len(t)} characters" for t in texts]


@query(
    "batch_generate",
    f"""
    select doc_id, label, len(string_split('summarize: ' || text, ' ')) || ' words, ' || length('summarize: ' || text) || ' characters' as output
    from ({LABELLED_SQL})
    """,
)
def batch_generate(spark, d):
    docs = labelled_documents(spark, d).select("doc_id", "label", tx.render_prompt("summarize: {t}", {"t": "text"}).alias("prompt"))
    return retrieval.generate(docs, "prompt", _count_words).drop("prompt")


@query(
    "compare_outputs",
    """
    select doc_id, len(string_split(text, ' ')) || ' words, ' || length(text) || ' characters' as output_a,
           len(string_split(trim(text), ' ')) || ' words, ' || length(trim(text)) || ' characters' as output_b,
           output_a = output_b as same from documents
    """,
)
def compare_outputs(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    first = retrieval.generate(docs, "text", _count_words)
    second = retrieval.generate(docs.withColumn("text", F.trim("text")), "text", _count_words)
    return retrieval.compare_outputs(first, second, "doc_id", "output")


@query(
    "map_batches",
    f"""
    select doc_id, case label when 0 then 'Medical Records' when 1 then 'Other' when 2 then 'Internal Medicine' else 'Surgery' end as target,
           length(text) as n_chars from ({LABELLED_SQL})
    """,
)
def map_batches(spark, d):
    from vitalis.plans.core_queries import CLASS_NAMES

    def run(batch):
        return batch.assign(target=[CLASS_NAMES[y] for y in batch["label"]], n_chars=batch["text"].str.len())[["doc_id", "target", "n_chars"]]

    return retrieval.map_batches(
        labelled_documents(spark, d), run, "doc_id long, target string, n_chars long", drop=["lang", "source", "quality", "toxic"]
    )


@query("chunk_documents")
def chunk_documents(spark, d):
    """All chunks of all documents; ``chunk_invariants`` states what must hold for them."""
    return retrieval.chunk(table(spark, d, "documents"), "doc_id", "text", 700, 20)


@query(
    "chunk_invariants",
    """
    select doc_id, size, true as within_size, true as matches_text, true as covers_text from documents, (values (700), (1000)) s(size)
    """,
)
def chunk_invariants(spark, d):
    """Chunks fit the size, equal the text at their start, and leave only white space uncovered."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    result = None
    for size, overlap in ((700, 20), (1000, 200)):
        chunks = retrieval.chunk(docs, "doc_id", "text", size, overlap)
        spans = chunks.groupBy("doc_id").agg(
            F.array_sort(F.collect_list(F.struct("start_index", F.length("text").alias("n"), F.md5("text").alias("digest")))).alias("spans")
        )
        whole = docs.join(spans, "doc_id")
        text = F.col("text")
        matches = F.forall("spans", lambda s: F.md5(F.substring(text, s["start_index"] + 1, s["n"])) == s["digest"])
        # walk the chunks in order and collect what lies between the end reached so far and the next start
        start = F.struct(F.lit(0).alias("end"), F.lit("").alias("gap"))

        def walk(state, s):
            ahead = s["start_index"] > state["end"]
            between = F.when(ahead, F.substring(text, state["end"] + 1, s["start_index"] - state["end"])).otherwise("")
            return F.struct(
                F.greatest(state["end"], s["start_index"] + s["n"]).alias("end"), F.concat(state["gap"], between).alias("gap")
            )

        rest = F.aggregate("spans", start, walk, lambda s: F.concat(s["gap"], F.substring(text, s["end"] + 1, F.length(text))))
        lines = whole.select(
            "doc_id",
            F.lit(size).alias("size"),
            F.forall("spans", lambda s: s["n"] <= size).alias("within_size"),
            matches.alias("matches_text"),
            (F.length(F.regexp_replace(rest, r"(?U)[\s]+", "")) == 0).alias("covers_text"),
        )
        result = lines if result is None else result.unionByName(lines)
    return result


@query(
    "embed_text",
    "select text_digest, true as same_vector, true as unit_norm from (select distinct md5(text) as text_digest from documents)",
)
def embed_text(spark, d):
    """Equal texts give one vector, and it has unit length (or is zero where a text has no term)."""
    from vitalis.operators.vectors import l2_norm

    made = retrieval.embed(_docs(spark, d).select("text"), "text", dim=256)
    has_terms = F.size(tx.terms("text")) > 0
    fits = F.abs(l2_norm("embedding") - F.when(has_terms, 1.0).otherwise(0.0)) < 1e-6
    return (
        made.select(F.md5("text").alias("text_digest"), fits.alias("fits"), F.md5(F.col("embedding").cast("string")).alias("v"))
        .groupBy("text_digest")
        .agg((F.min("v") == F.max("v")).alias("same_vector"), F.bool_and("fits").alias("unit_norm"))
    )


@query(
    "rag_chunk_context",
    """
    select concat_ws('-', conv_id, turn) as query_id, 4 as n_hits, true as from_documents, true as best_first
    from conversations where role = 'user'
    """,
)
def rag_chunk_context(spark, d):
    """Documents cut into chunks of 1,000, embedded, and searched: four chunks make each context.

    Every chunk of a context must be a part of its document, and none may score above the one before.
    """
    questions = _questions(spark, d)
    index = durable(retrieval.embed(retrieval.chunk(table(spark, d, "documents"), "doc_id", "text", 1000, 200), "text"), COMPACT)
    hits = durable(retrieval.search_chunks(questions, index, 4, stored=True))
    parts = index.select(retrieval.chunk_id().alias("id"), "doc_id", "start_index", F.col("text").alias("part"))
    whole = hits.join(parts, "id").join(_docs(spark, d), "doc_id")
    same = F.substr("text", F.col("start_index") + 1, F.length("part")) == F.col("part")
    scores = F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda h: h["score"])
    return whole.groupBy("query_id").agg(
        F.count(F.lit(1)).cast("int").alias("n_hits"),
        F.bool_and(same).alias("from_documents"),
        (F.reverse(F.array_sort(scores)) == scores).alias("best_first"),
    )
