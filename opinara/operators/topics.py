"""Topic model: corpus, vocabulary, LDA, labels and assignment."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import LDAModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.topics import model_words, preprocess_for_topics, with_bigrams
from ..functions.wordlists import TOPIC_RULES
from ..sources.scratch import discard, write_once
from .dedup import text_key, top_k_per_group
from .keyed_join import join_unique
from .lda import OnlineLDA, TopicModel, fit_together, held, log_perplexities
from .terms import count_pairs, count_words, entries_by, packed_vectors

# --- fixed values: model settings -------------------------------------------
MIN_TEXT_LENGTH = 10
MIN_TOKENS = 2
MAX_FEATURES = 1500
SEARCH_MAX_DF, SEARCH_MIN_DF, SEARCH_ITERATIONS = 0.80, 5, 20
FINAL_MAX_DF, FINAL_MIN_DF, FINAL_ITERATIONS = 0.85, 3, 50
DOC_TOPIC_PRIOR, TOPIC_WORD_PRIOR, SEED = 0.1, 0.01, 42
MIN_TOPICS, MAX_TOPICS = 3, 15
FLAT_STEP_PCT = 5.0
TOP_WORDS, LABEL_WORDS = 10, 5
# Candidate counts fitted at once; a curve is not judged on fewer points.
AT_ONCE, LEAST_POINTS = 3, 3
WORDS = "__words"
# Only the plan depends on it: a lemma table of so many tokens reaches the workers as arrays.
LEMMAS_AT_ONCE = 1_000_000
# About so many tokens of lists are spelled together beyond that.
CHUNK_TOKENS = 1 << 19


def prepare_corpus(df: DataFrame, text: str = "final_text", **options) -> DataFrame:
    """Reviews with ``tokens``; short texts and texts of fewer than two tokens drop out."""
    return (
        df.filter(F.length(text) >= MIN_TEXT_LENGTH)
        .withColumn("tokens", preprocess_for_topics(text, **options))
        .filter(F.size("tokens") >= MIN_TOKENS)
    )


def lemmatise(df: DataFrame, lemmas: DataFrame, tokens: str = "tokens", at_once: int = LEMMAS_AT_ONCE) -> DataFrame:
    """Replace tokens by their lemma from a table (token, lemma), keeping word order.

    Of several lemmas of a token the first by name is used.  A table of at most ``at_once``
    tokens is looked up where the rows are.  A longer one meets the tokens of every chunk of
    distinct lists, each once, in a shuffle join; no list is taken apart into rows.  Rows are
    matched by their tokens, so ids may repeat.
    """
    one = write_once(
        lemmas.filter("token IS NOT NULL AND lemma IS NOT NULL").groupBy("token").agg(F.min("lemma").alias("lemma")), "lemma_table")
    if one.count() <= at_once:
        return df.withColumn(tokens, _looked_up(one)(F.col(tokens)))
    some = F.coalesce(F.size(tokens) > 0, F.lit(False))
    keyed = df.filter(some).withColumn("__tokens_key", text_key(F.to_json(F.struct(tokens))))
    packed = keyed.select("__tokens_key", tokens).mapInArrow(_packed_lists, "__lists binary")
    chunks = write_once(packed.withColumn("__chunk", F.monotonically_increasing_id()), "token_lists")
    keys = chunks.mapInArrow(_keys_of_chunks, "__chunk bigint, token string, n bigint").groupBy("token").agg(
        F.min("__chunk").alias("__chunk"), F.sum("n").alias("n"))
    keys = write_once(keys, "list_keys")
    found = chunks.mapInArrow(_tokens_of_chunks, "__chunk bigint, token string").join(one, "token")
    # a key without a lemma: its list is spelled in this chunk and in no other
    found = found.unionByName(keys.select("__chunk", "token", F.lit(None).cast("string").alias("lemma")))
    rebuilt = chunks.groupBy("__chunk").cogroup(found.groupBy("__chunk"))
    spelled = write_once(rebuilt.applyInArrow(_spelled_chunk, "__tokens_key string, __lemmas array<string>"), "lemmas")
    discard(chunks)
    out = join_unique(keyed.drop(tokens), spelled, ["__tokens_key"], counts=keys.select(F.col("token").alias("__tokens_key"), "n"))
    return out.withColumnRenamed("__lemmas", tokens).select(*df.columns).unionByName(df.filter(~some))


def _packed_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of keyed lists, each list once, with the number of its rows, as compressed Arrow streams."""
    for batch in batches:
        words = pc.sum(pc.list_value_length(batch.column(1))).as_py() or 0
        rows = max(1, len(batch) * CHUNK_TOKENS // max(words, 1))
        for at in range(0, len(batch), rows):
            part = batch.slice(at, rows)
            keys = part.column(0).dictionary_encode().indices.to_numpy()
            _, first, n = np.unique(keys, return_index=True, return_counts=True)
            own = part.column(1).take(pa.array(first))
            coded = pa.ListArray.from_arrays(own.offsets, own.values.cast(pa.string()).dictionary_encode())
            lists = pa.table({"key": part.column(0).take(pa.array(first)), "list": coded, "n": n})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, lists.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(lists)
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["__lists"])


def _unpacked(chunks: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, pa.Table]]:
    for r in chunks.to_pylist():
        table = pa.ipc.open_stream(r["__lists"]).read_all().combine_chunks()
        coded = table["list"].combine_chunks()
        lists = pa.ListArray.from_arrays(coded.offsets, coded.values.cast(pa.string()))
        yield r["__chunk"], table.set_column(1, "list", lists)


def _keys_of_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, key, rows) of the lists."""
    for chunk, lists in (x for batch in batches for x in _unpacked(batch)):
        columns = [pa.array(np.full(len(lists), chunk)), *(lists[c].combine_chunks() for c in ("key", "n"))]
        yield pa.RecordBatch.from_arrays(columns, ["__chunk", "token", "n"])


def _tokens_of_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, token) of the lists, each pair once."""
    for chunk, lists in (x for batch in batches for x in _unpacked(batch)):
        tokens = pc.drop_null(pc.unique(lists["list"].combine_chunks().flatten().cast(pa.string())))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(tokens), chunk)), tokens], ["__chunk", "token"])


def _spelled_chunk(chunks: pa.Table, found: pa.Table) -> pa.Table:
    """The lists that a chunk is the first to have, with the lemmas found for its tokens."""
    keys = [pa.array([], pa.string())]
    spelled = [pa.array([], pa.list_(pa.string()))]
    is_key = pc.is_null(found["lemma"])
    known, lemma = (found.filter(pc.invert(is_key))[c].combine_chunks().cast(pa.string()) for c in ("token", "lemma"))
    own = found.filter(is_key)["token"].combine_chunks().cast(pa.string())
    for _, lists in _unpacked(chunks):
        lists = lists.filter(pc.is_in(lists["key"].cast(pa.string()), value_set=own))
        keys.append(lists["key"].combine_chunks().cast(pa.string()))
        spelled.append(_with_lemmas(lists["list"].combine_chunks(), known, lemma))
    return pa.table({"__tokens_key": pa.concat_arrays(keys), "__lemmas": pa.concat_arrays(spelled)})


def _with_lemmas(lists: pa.Array, known: pa.Array, lemma: pa.Array) -> pa.Array:
    words = lists.flatten().cast(pa.string()).dictionary_encode()
    found = lemma.take(pc.index_in(words.dictionary, value_set=known))
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    new = pc.coalesce(found, words.dictionary).take(words.indices)
    return pa.ListArray.from_arrays(ends, new, mask=lists.is_null())


def _looked_up(one: DataFrame) -> Callable[[Column], Column]:
    """Lists of tokens with the lemmas of a table of bounded size, a batch at a time."""
    table = one.select("token", "lemma").toArrow()
    shared = one.sparkSession.sparkContext.broadcast([table[c].combine_chunks().cast(pa.string()) for c in ("token", "lemma")])

    @F.arrow_udf("array<string>")
    def spelled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            yield _with_lemmas(lists, *shared.value)

    return spelled


def topic_terms(corpus: DataFrame, fold_accents: bool = False) -> DataFrame:
    """Add ``__words``, the plain-letter ones, and ``terms``, the words and their bigrams."""
    return corpus.withColumn(WORDS, model_words("tokens", fold_accents)).withColumn("terms", with_bigrams(WORDS))


def term_counts(corpus: DataFrame, min_df: int = FINAL_MIN_DF) -> DataFrame:
    """(term, term_count, doc_count) of all terms in at least ``min_df`` documents.

    Counts are reduced map-side.  Terms are sorted inside each document, so that the first
    of equal ones can count the document while all of them count the term.
    """
    own = corpus.select(F.sort_array("terms").alias("__own"))
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice("__own", 1, F.size("__own") - 1))
    first = F.zip_with(
        "__own", before,
        lambda t, b: F.struct(t.alias("term"), (~t.eqNullSafe(b)).cast("int").alias("first")),
    )
    counts = own.filter(F.size("__own") > 0).select(F.inline(first)).groupBy("term").agg(
        F.count("*").alias("term_count"), F.sum("first").alias("doc_count")
    )
    return counts.filter(F.col("doc_count") >= min_df)


def vocabulary_of(
    counts: DataFrame, documents: int, max_df: float = FINAL_MAX_DF, min_df: int = FINAL_MIN_DF,
    max_features: int = MAX_FEATURES,
) -> DataFrame:
    """The most frequent of counted terms.

    Terms in more than ``max_df`` of the documents or in fewer than ``min_df`` are left
    out; ties go to the smaller term.
    """
    kept = counts.filter(F.col("doc_count").between(min_df, math.floor(max_df * documents + 1e-9)))
    return kept.orderBy(F.col("term_count").desc(), "term").limit(max_features)


def topic_vocabulary(
    corpus: DataFrame, max_df: float = FINAL_MAX_DF, min_df: int = FINAL_MIN_DF,
    max_features: int = MAX_FEATURES, documents: int | None = None,
) -> DataFrame:
    """(term, term_count, doc_count) of the vocabulary of a corpus."""
    total = corpus.count() if documents is None else documents
    return vocabulary_of(term_counts(corpus, min_df), total, max_df, min_df, max_features)


def vectorise(corpus: DataFrame, vocabulary: list[str], features: str = "features") -> DataFrame:
    """Add ``features``: sparse term counts over the vocabulary."""
    model = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="terms", outputCol=features)
    return model.transform(corpus)


def vector_rows(vectors: DataFrame, vocabulary: list[str], features: str = "features") -> DataFrame:
    """Sparse vectors as rows: all other columns, ``term`` and ``count`` of every entry."""
    names = F.array(*[F.lit(v) for v in vocabulary])
    inner = F.unwrap_udt(features)
    entries = F.arrays_zip(inner["indices"].alias("i"), inner["values"].alias("v"))
    others = [c for c in vectors.columns if c != features]
    return vectors.select(*others, F.explode(entries).alias("__e")).select(
        *others, F.element_at(names, F.col("__e.i") + 1).alias("term"), F.col("__e.v").cast("bigint").alias("count"))


def _listed(vocabulary: DataFrame) -> list[str]:
    """A vocabulary as a list: at most its ``max_features`` terms reach the driver."""
    return sorted(r["term"] for r in vocabulary.select("term").collect())


def _lda(k: int, iterations: int, features: str = "features") -> OnlineLDA:
    return OnlineLDA(k, iterations, DOC_TOPIC_PRIOR, TOPIC_WORD_PRIOR, SEED, features)


def _finite(topic_counts: list[int], perplexities: list[float]) -> list[tuple[int, float]]:
    return [(k, p) for k, p in zip(topic_counts, perplexities) if math.isfinite(p)]


def _first_flat(points: list[tuple[int, float]]) -> int | None:
    """The count before the first step that changes perplexity by less than 5 %, given enough points."""
    if len(points) >= LEAST_POINTS:
        for (k, p), (_, after) in zip(points, points[1:]):
            if abs(after - p) / p * 100 < FLAT_STEP_PCT:
                return k
    return None


def pick_topic_count(topic_counts: list[int], perplexities: list[float], default: int = MIN_TOPICS) -> int:
    """The count before the first step that changes perplexity by less than 5 %.

    Without such a step, or with fewer than three points, the lowest perplexity
    wins.
    """
    points = _finite(topic_counts, perplexities)
    if not points:
        return default
    flat = _first_flat(points)
    return min(points, key=lambda kp: kp[1])[0] if flat is None else flat


def pick_topic_counts(curves: DataFrame, keys: list[str]) -> DataFrame:
    """``pick_topic_count`` for many corpora: ``topic_count`` per ``keys`` of curves (topic_count, perplexity).

    A curve has as many points as counts were tried, so it fits one row of a group.
    """
    finite = F.col("perplexity").isNotNull() & ~F.isnan("perplexity") & (F.abs("perplexity") != float("inf"))
    step = F.abs(F.lead("perplexity").over(_curve(keys)) - F.col("perplexity")) / F.col("perplexity") * 100
    points = curves.filter(finite).withColumn("__flat", step < FLAT_STEP_PCT)
    enough = F.count("*") >= LEAST_POINTS
    first_flat = F.when(enough, F.min(F.when(F.col("__flat"), F.col("topic_count"))))
    lowest = F.min(F.struct("perplexity", "topic_count"))["topic_count"]
    return points.groupBy(*keys).agg(F.coalesce(first_flat, lowest).alias("topic_count"))


def _curve(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("topic_count")


def _at_once(spark, jobs: list[Callable[[], float]]) -> list[float]:
    """Results of Spark jobs that run at the same time, each in a scheduler pool of its own.

    With ``spark.scheduler.mode=FAIR`` they share the executors evenly.
    """
    def pooled(number: int, job: Callable[[], float]) -> float:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"topics-{number}")
        try:
            return job()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        # each job inherits the session's properties anew
        return list(pool.map(lambda x: inheritable_thread_target(spark)(pooled)(*x), enumerate(jobs)))


def search_topic_counts(
    vectors: DataFrame, topic_counts: Iterable[int], iterations: int = SEARCH_ITERATIONS,
    at_once: int = AT_ONCE, features: str = "features", whole: bool = False,
    models: dict[int, TopicModel] | None = None,
) -> list[tuple[int, float]]:
    """(count, perplexity) of the counts that were fitted, in order.

    ``at_once`` models are fitted at the same time on the held vectors, in the same passes.
    The search stops when no later point can change the choice: with three finite points the
    first flat step decides, wherever the curve goes from there.  ``whole=True`` fits them all.
    Where a pass has tasks for all cores, a search that may stop goes on one count at a time.
    ``models`` takes the fitted models.
    """
    left, found = list(topic_counts), []
    enough = vectors.rdd.getNumPartitions() >= vectors.sparkSession.sparkContext.defaultParallelism

    def perplexities(counts: list[int]) -> list[float]:
        settings = [_lda(k, iterations, features) for k in counts]
        if not all(isinstance(s, OnlineLDA) for s in settings):
            jobs = [lambda s=s: math.exp(s.fit(vectors).logPerplexity(vectors)) for s in settings]
            return _at_once(vectors.sparkSession, jobs)
        fitted = fit_together(settings, vectors)
        if models is not None:
            models.update(zip(counts, fitted))
        return [math.exp(p) for p in log_perplexities(fitted, vectors)]

    while left:
        some = at_once if whole or len(found) < LEAST_POINTS or not enough else 1
        now, left = left[:some], left[some:]
        found += zip(now, perplexities(now))
        if not whole and _first_flat(_finite(*zip(*found))) is not None:
            break
    return found


def choose_topic_count(
    corpus: DataFrame | Prepared, min_topics: int = MIN_TOPICS, max_topics: int = MAX_TOPICS,
    iterations: int = SEARCH_ITERATIONS, at_once: int = AT_ONCE, whole: bool = False,
) -> int:
    """Fit models of growing topic count and pick by perplexity; ``corpus`` has ``__words`` or ``terms``, or is prepared."""
    return _choose(prepared(corpus), min_topics, max_topics, iterations, at_once, whole)


class Prepared(NamedTuple):
    """Written vectors over both vocabularies, the number of documents, and the vocabularies."""

    vectors: DataFrame
    documents: int
    search: list[str]
    final: list[str]

    def held(self, name: str):
        """Vectors over one of the vocabularies, kept while models pass over them."""
        return held(self.vectors, name, len(getattr(self, name)) if dict(self.vectors.dtypes)[name] == "binary" else None)


def prepared(corpus: DataFrame | Prepared) -> Prepared:
    """Vectors and vocabularies of a corpus.

    Terms are counted once for the two, and both vectors of a review leave one pass.
    """
    if isinstance(corpus, Prepared):
        return corpus
    documents = corpus.count()
    counts, by_words = _counted(corpus, documents)
    search = _listed(vocabulary_of(counts, documents, SEARCH_MAX_DF, SEARCH_MIN_DF))
    final = _listed(vocabulary_of(counts, documents, FINAL_MAX_DF, FINAL_MIN_DF))
    if by_words:
        return Prepared(write_once(packed_vectors(corpus, {"search": search, "final": final}), "topic_vectors"), documents, search, final)
    vectors = corpus.select("terms")
    for name, vocabulary in (("search", search), ("final", final)):
        vectors = vectorise(vectors, vocabulary, name) if vocabulary else vectors
    vectors = write_once(vectors.drop("terms"), "topic_vectors") if search or final else vectors
    return Prepared(vectors, documents, search, final)


def _counted(corpus: DataFrame, documents: int, at_once: int = LEMMAS_AT_ONCE) -> tuple[DataFrame, bool]:
    """Counts of all terms that can enter a vocabulary, and whether they came from ``__words``.

    The last of the most frequent words tells how often a term occurs at least; pairs of rarer
    words are left out.  More than ``at_once`` words above that are counted as terms.
    """
    least = min(SEARCH_MIN_DF, FINAL_MIN_DF)
    if WORDS in corpus.columns:
        words = write_once(count_words(corpus).filter(F.col("doc_count") >= least), "topic_words")
        often = []
        for max_df, min_df in ((SEARCH_MAX_DF, SEARCH_MIN_DF), (FINAL_MAX_DF, FINAL_MIN_DF)):
            n, count = vocabulary_of(words, documents, max_df, min_df).agg(F.count("*"), F.min("term_count")).first()
            often.append(count if n == MAX_FEATURES else 0)
        frequent = words.filter(F.col("term_count") >= min(often))
        if frequent.count() <= at_once:
            known = frequent.select("term").toArrow()["term"].combine_chunks().cast(pa.string())
            return write_once(frequent.unionByName(count_pairs(corpus, known, min(often), least)), "topic_terms"), True
    if "terms" not in corpus.columns:
        corpus = corpus.withColumn("terms", with_bigrams(WORDS))
    return write_once(term_counts(corpus, least), "topic_terms"), WORDS in corpus.columns


def _choose(
    ready: Prepared, min_topics: int, max_topics: int, iterations: int, at_once: int, whole: bool = False,
    models: dict[int, TopicModel] | None = None,
) -> int:
    if not ready.search:
        return min_topics
    top = min(max_topics, ready.documents // 5, len(ready.search) // 10)
    with ready.held("search") as kept:
        found = search_topic_counts(kept, range(min_topics, top + 1), iterations, at_once, "search", whole, models)
    return pick_topic_count([k for k, _ in found], [p for _, p in found], min_topics)


def default_topic_count(documents: int) -> int:
    """Topic count when no search was made: one per 30 documents, within 3..8."""
    return max(3, min(8, documents // 30))


def fit_topics(
    corpus: DataFrame, k: int | None = None, iterations: int = FINAL_ITERATIONS
) -> tuple[TopicModel, list[str]] | None:
    """(model, vocabulary) of a corpus with ``__words`` or ``terms``; None when no term qualifies."""
    return _fit(prepared(corpus), k, iterations)


def _fit(
    ready: Prepared, k: int | None, iterations: int, models: dict[int, TopicModel] | None = None
) -> tuple[TopicModel, list[str]] | None:
    """Fit the final model, from a model of the search on where that saw the same vectors."""
    if not ready.final:
        return None
    k = default_topic_count(ready.documents) if k is None else min(k, len(ready.final))
    k = max(k, 2)
    begun = (models or {}).get(k) if ready.search == ready.final else None
    if begun is not None and begun.state[0] > iterations:
        begun = None
    with ready.held("final") as kept:
        return _lda(k, iterations, "final").fit(kept, begun), ready.final


def topic_words(model: TopicModel | LDAModel, vocabulary: list[str], n: int = TOP_WORDS) -> DataFrame:
    """(topic_id, rank, word): the heaviest words of every topic, rank from 0."""
    described = model.describeTopics(n)
    names = F.array(*[F.lit(v) for v in vocabulary])
    return described.select(
        F.col("topic").alias("topic_id"), F.posexplode("termIndices").alias("rank", "index")
    ).select("topic_id", "rank", F.element_at(names, F.col("index") + 1).alias("word"))


def label_topics(words: DataFrame, rules: Iterable[tuple[str, str]] = TOPIC_RULES) -> DataFrame:
    """(topic_id, topic_name) from ranked words.

    Among the five heaviest words the first that contains a rule key gives the
    label.  Otherwise the first two long words of the top three are joined, or
    the one there is, or the first two words.
    """
    word, rank = F.col("word"), F.col("rank")
    ruled = None
    for key, label in rules:
        hit = F.contains(F.lower(word), F.lit(key.lower()))
        ruled = F.when(hit, label) if ruled is None else ruled.when(hit, label)
    ruled = F.when(rank < LABEL_WORDS, ruled)
    top = words.filter(rank < TOP_WORDS).withColumn("__label", ruled)
    grouped = top.groupBy("topic_id").agg(
        F.min_by("__label", F.when(F.col("__label").isNotNull(), rank)).alias("__label"),
        # At most three words per topic.
        F.sort_array(F.collect_list(F.when(rank < 3, F.struct("rank", "word")))).alias("__top"),
    )
    first = F.transform("__top", lambda s: F.initcap(s["word"]))
    long = F.filter(first, lambda w: F.length(w) > 3)
    two = lambda a: F.array_join(F.slice(a, 1, 2), "_")
    name = (
        F.when(F.col("__label").isNotNull(), F.col("__label"))
        .when(F.size(long) >= 1, two(long))
        .when(F.size(first) >= 1, two(first))
        .otherwise("Unknown_Topic")
    )
    return grouped.select("topic_id", name.alias("topic_name"))


def _assignment_columns(df: DataFrame, topic_id, name, confidence) -> DataFrame:
    return df.withColumns({
        "topic_id": F.lit(topic_id), "topic_name": F.lit(name), "topic_confidence": F.lit(confidence),
    })


def assign_topics(
    corpus: DataFrame, fitted: tuple[TopicModel | LDAModel, list[str]] | None, labels: DataFrame | None = None
) -> DataFrame:
    """Add the most probable topic, its label and its probability.

    Scoring is a narrow map over the reviews.  Without a model every review gets
    -1, ``Model_Error`` and 0.
    """
    if fitted is None:
        return _assignment_columns(corpus, -1, "Model_Error", 0.0)
    model, vocabulary = fitted
    if labels is None:
        labels = label_topics(topic_words(model, vocabulary))
    k = model.getK() if hasattr(model, "getK") else model.getOrDefault("k")
    names = {r["topic_id"]: r["topic_name"] for r in labels.collect()}  # k rows
    name_list = F.array(*[F.lit(names.get(i, f"Topic_{i}")) for i in range(k)])
    if isinstance(model, TopicModel) and WORDS in corpus.columns:
        scored = corpus.withColumn("__p", model.distribution_by(lambda: entries_by(vocabulary), WORDS))
    elif isinstance(model, TopicModel):
        scored = vectorise(corpus, vocabulary).withColumn("__p", model.distribution("features"))
    else:
        scored = model.transform(vectorise(corpus, vocabulary)).withColumn("__p", vector_to_array("topicDistribution"))
    # A review without any vocabulary term has a zero vector: all topics are equal.
    best = F.array_max("__p")
    topic = F.when(best > 0, F.array_position("__p", best) - 1).otherwise(F.lit(0)).cast("int")
    return scored.withColumn("topic_id", topic).select(
        *corpus.columns, "topic_id",
        F.element_at(name_list, F.col("topic_id") + 1).alias("topic_name"),
        F.round(F.when(best > 0, best).otherwise(F.lit(1.0 / k)), 4).alias("topic_confidence"),
    )


def fill_topics(df: DataFrame) -> DataFrame:
    return df.fillna({"topic_confidence": 0.0, "topic_name": "Unclassified", "topic_id": -1})


def merge_topics(original: DataFrame, assigned: DataFrame, key: str = "id") -> DataFrame:
    """All reviews with their topic; reviews outside the corpus are Unclassified.

    ``assigned`` is reduced to one row per key first, so repeated keys do not
    multiply reviews.
    """
    columns = ["topic_id", "topic_name", "topic_confidence"]
    order = [F.col("topic_id"), F.col("topic_name"), F.col("topic_confidence")]
    unique = top_k_per_group(assigned.select(key, *columns), [key], order, 1)
    return fill_topics(join_unique(original, unique, [key]))


def extract_topics(
    reviews: DataFrame, text: str = "final_text", k: int | None = None, search: bool = True,
    iterations: int = FINAL_ITERATIONS, search_iterations: int = SEARCH_ITERATIONS,
    fold_accents: bool = False, lemmas: DataFrame | None = None,
) -> DataFrame:
    """The whole topic step: corpus, topic count, model, labels, assignment.

    Reviews are scored in place (those outside the corpus become Unclassified),
    so no join by id is needed.  With ``lemmas(token, lemma)`` tokens are replaced first.
    """
    spelled = (lambda df: df) if lemmas is None else (lambda df: lemmatise(df, lemmas))
    corpus = topic_terms(spelled(prepare_corpus(reviews.select(text), text)), fold_accents)
    ready, models = prepared(write_once(corpus.select(WORDS), "topic_corpus")), {}
    if k is None and search:
        k = _choose(ready, MIN_TOPICS, MAX_TOPICS, search_iterations, AT_ONCE, models=models)
    fitted = _fit(ready, k, iterations, models)
    tokens = preprocess_for_topics(text)
    terms = topic_terms(spelled(reviews.withColumn("tokens", tokens)), fold_accents)
    inside = (F.length(text) >= MIN_TEXT_LENGTH) & (F.size("tokens") >= MIN_TOKENS)
    scored = assign_topics(terms, fitted)
    columns = ["topic_id", "topic_name", "topic_confidence"]
    return fill_topics(scored.select(
        *reviews.columns, *[F.when(inside, F.col(c)).alias(c) for c in columns]
    ))
