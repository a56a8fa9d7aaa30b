"""Language identification by Bayesian fusion of text, markup, address and host.

For a document and each language l the log posterior is the sum of

* log P(text | l): hashed byte trigrams under one smoothed multinomial per language, with the weight of at
  most ``EVIDENCE`` trigrams, as neighbouring trigrams are not independent;
* log P(declared | l) for the language that the markup (or the metadata) declares, and log P(suffix | l) for the
  end of the address: tables of how often each value comes with each language, smoothed;
* log P(l | host): the host's own mix of languages, smoothed towards its domain's, which is smoothed towards
  that of the whole table.

A model fitted with ``unknown`` gives a trigram that a language has not seen the same probability in all languages, so that
such trigrams do not favour the one with the least training text, and has ``und`` as one more class, for texts of no
known language: log P(text | und) is that of the best language less the log odds of this language against a background that knows only how frequent single bytes are, half
of its mass spread over all buckets. For these odds the language's counts are backed off to the background with the
weight of its distinct trigrams (Witten and Bell), so an unseen trigram speaks the more against a language the more text
it was fitted on; a document that was itself in the sample (told by ``key``) has its own part taken out, so that junk
which declares a language does not vouch for itself (copies of it in the sample still do). Declarations, suffixes and hosts have their tables for ``und`` as for any language. The registered
queries and the pipeline ask for it; without ``unknown`` the posterior is one among the known languages alone, which
rejects hardly any text with letters.

The three kinds of tables are grouped sums of the text-only posteriors, so no label is needed for them; a
document's own part is taken out of its host's and domain's counts. Only the trigram model is fitted, on a
sample of at most ``per_language`` labelled texts of each language (whole texts, the smallest hashes of
``doc_id``); everything else covers all rows.

Defined cases: a text that is NULL, empty or without a letter gives no evidence; other evidence then decides. A
document is accepted if its best posterior is at least ``threshold``, its text has a letter trigram, and its best class
is a known language. Labels and declarations are reduced to their primary subtag (``en-US`` and ``en_GB`` are ``en``).
What is no tag, ``und``, and labels beyond the ``MOST_LANGUAGES`` that most texts have (ties by name) count as none for
the fit, and as ``other`` where declared.
Missing declarations, suffixes or hosts give no evidence. Ties go to the first language by name. Repeated rows are
judged alike, each as a row of its own. Without a labelled text there is one language, ``und``, which is then accepted,
as there is nothing to tell it from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscope.llm.common import Scratch, as_bytes, bounded_batches, packed, unpacked

BUCKETS = 1 << 16
PER_LANGUAGE = 2000
MOST_LANGUAGES = 400
EVIDENCE = 60
THRESHOLD = 0.5
SMOOTHING = 8.0
HOST_SALTS = 32
UNKNOWN = "und"

# Letters (and all bytes from 0x80 on) stand for themselves, A-Z as a-z, all else is a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def folded(text: bytes | None) -> np.ndarray:
    """Folded bytes, spaces run together, a space at both ends; none without a letter."""
    words = text.translate(_FOLD).split() if text else []
    return np.frombuffer(b" " + b" ".join(words) + b" " if words else b"", dtype=np.uint8)


def trigram_buckets(text: bytes | None) -> np.ndarray:
    """Bucket of every byte trigram that has a letter, spaces run together, a space at both ends."""
    return _buckets(folded(text))


def _buckets(own: np.ndarray) -> np.ndarray:
    if not len(own):
        return np.zeros(0, dtype=np.int64)
    b = own.astype(np.uint32)
    mixed = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
    return (mixed >> np.uint32(16)).astype(np.int64)


@dataclass
class TextModel:
    languages: list[str]
    log_p: np.ndarray  # BUCKETS x languages, float32
    # With ``unknown`` only: trigrams counted and buckets they fill, by language, and the share of every byte, over
    # languages of equal weight.
    trigrams: np.ndarray | None = None
    distinct: np.ndarray | None = None
    letters: np.ndarray | None = None
    last: dict[str, int] | None = None  # largest hash that the sample took, by language

    @property
    def classes(self) -> list[str]:
        return self.languages if self.letters is None else [*self.languages, UNKNOWN]

    def log_likelihood(self, text: bytes | None, counted: str | None = None) -> tuple[np.ndarray, int]:
        """Summed log P of the trigrams by class, and their number; ``counted`` is the language whose sample has the text."""
        own = folded(text)
        buckets = _buckets(own)
        total = np.zeros(len(self.languages))
        for at in range(0, len(buckets), 1 << 18):
            total += self.log_p[buckets[at:at + (1 << 18)]].sum(axis=0, dtype=np.float64)
        if self.letters is not None:
            best = int(total.argmax())
            mine = np.bincount(buckets, minlength=BUCKETS) if counted == self.languages[best] else None
            step = 1 << 18
            odds = sum(self._log_odds(best, own[at:at + step + 2], buckets[at:at + step], mine) for at in range(0, len(buckets), step))
            total = np.append(total, total[best] - odds)
        return total, len(buckets)

    def _log_odds(self, k: int, own: np.ndarray, buckets: np.ndarray, mine: np.ndarray | None) -> float:
        """log P of the trigrams in language k, backed off to the background, less that in the background.

        ``mine`` are the text's own counts, if they are among those of the language.
        """
        share = self.letters[own]
        background = 0.5 * share[:-2] * share[1:-1] * share[2:] + 0.5 / BUCKETS
        size, distinct = self.trigrams[k], self.distinct[k]
        seen = np.maximum(np.exp(self.log_p[buckets, k].astype(np.float64)) * (size + 0.1 * BUCKETS) - 0.1, 0.0)
        if mine is not None:
            seen = np.maximum(np.rint(seen) - mine[buckets], 0.0)
            size = size - mine.sum()
        return float(np.log((seen / background + distinct) / (size + distinct)).sum())


def fit(
    labelled: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "lang", per_language: int = PER_LANGUAGE,
    unknown: bool = False,
) -> TextModel:
    """Trigram model from at most ``per_language`` texts of each language, with the class ``und`` if ``unknown``; runs two jobs."""
    rows = labelled.select(
        F.xxhash64(F.col(key).cast("string")).alias("h"), F.col(text).alias("text"), primary_tag(F.col(label)).alias("label")
    ).filter(f"label is not null and label <> '{UNKNOWN}' and text is not null")
    most = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(MOST_LANGUAGES)
    counts = {r.label: r["count"] for r in most.collect()}
    if not counts:
        return TextModel([UNKNOWN], np.full((BUCKETS, 1), -np.log(BUCKETS), dtype=np.float32))
    languages = sorted(counts)
    # Cut by hash first: about the number wanted, with a margin. The exact rank then works on few rows.
    cut = F.lit(None).cast("double")
    for name in languages:
        share = min(1.0, 1.5 * per_language / counts[name] + 64 / counts[name])
        cut = F.when(F.col("label") == name, F.lit(share)).otherwise(cut)
    near = rows.filter(_place(F.col("h")) < cut * (1 << 30))
    rank = F.row_number().over(Window.partitionBy("label").orderBy(_place(F.col("h")), "h", "text"))
    sample = near.select("label", "text", _place(F.col("h")).alias("place"), rank.alias("rank")).filter(F.col("rank") <= per_language)

    def count(batches):
        sums: dict[str, np.ndarray] = {}  # counts of the buckets, then those of the bytes
        last: dict[str, int] = {}
        for batch in batches:
            for name, place, value in zip(batch.column("label").to_pylist(), batch.column("place").to_pylist(), as_bytes(batch.column("text"))):
                last[name] = max(last.get(name, 0), place)
                own = sums.setdefault(name, np.zeros(BUCKETS + 256, dtype=np.int64))
                text = folded(value)
                own[:BUCKETS] += np.bincount(_buckets(text), minlength=BUCKETS)
                own[BUCKETS:] += np.bincount(text, minlength=256)
        for name, own in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([own.tobytes()]), pa.array([last[name]], pa.int64())], names=["label", "counts", "last"]
            )

    bounded_batches(labelled.sparkSession)
    total = {name: np.zeros(BUCKETS + 256) for name in languages}
    last: dict[str, int] = {}
    for r in sample.select("label", "place", "text").mapInArrow(count, "label string, counts binary, last long").toLocalIterator():
        last[r.label] = max(last.get(r.label, 0), r.last)
        total[r.label] += np.frombuffer(r.counts, dtype=np.int64)
    seen = np.array([total[name][:BUCKETS] for name in languages]).T
    size = seen.sum(axis=0)
    log_p = np.log((seen + 0.1) / (size + 0.1 * BUCKETS))
    if not unknown:
        return TextModel(languages, log_p.astype(np.float32))
    # One floor for all: the lowest, so that no language's probabilities sum to more than one.
    log_p[seen == 0] = np.log(0.1 / (size.max() + 0.1 * BUCKETS))
    letters = np.array([total[name][BUCKETS:] for name in languages])
    letters = (letters / np.maximum(letters.sum(axis=1, keepdims=True), 1.0)).mean(axis=0)
    return TextModel(languages, log_p.astype(np.float32), size, (seen > 0).sum(axis=0), letters, last)


def _place(h: Column) -> Column:
    """Where a hash stands in the order of the sample."""
    return F.pmod(h, F.lit(1 << 30))


def primary_tag(tag: Column) -> Column:
    """Primary subtag of a language tag, in lower case; NULL for what is no tag."""
    found = F.regexp_extract(tag, r"^\s*([A-Za-z]{2,8})(?:[-_.@][A-Za-z0-9]+)*\s*$", 1)
    return F.when(found != "", F.lower(found))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))


def domain_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.when(F.instr(host, ".") > 0, F.substring_index(host, ".", -1))


def declared_in(html: Column) -> Column:
    """Primary subtag of the language that an <html> element declares."""
    tag = F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]{2,3})", 1)
    return F.when(tag != "", F.lower(tag))


def visible_text(html: Column) -> Column:
    """Text between tags, without scripts and styles."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", " "), r"&[A-Za-z#0-9]+;", " ")


def identify(
    documents: DataFrame, model: TextModel, *, text: Column, declared: Column, host: Column, keep: dict[str, Column],
    key: Column | None = None, threshold: float = THRESHOLD, scratch: Scratch | None = None,
) -> DataFrame:
    """The ``keep`` columns, ``language``, ``posterior`` and ``accepted`` of each row.

    ``text``, ``declared`` and ``host`` are expressions over ``documents`` (NULL literals where there is none);
    ``key`` is the fitted table's key, if the model was fitted on these documents with ``declared`` as label. The
    text is read once; what follows works on a narrow table in the shared folder.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    scratch = scratch or Scratch(spark, "language")
    names = model.classes
    shared = spark.sparkContext.broadcast(model)

    def score(batches):
        own: TextModel = shared.value
        for batch in batches:
            likelihood, evidence = [], []
            for value, counted in zip(as_bytes(batch.column("text")), batch.column("counted").to_pylist()):
                total, n = own.log_likelihood(value, counted)
                likelihood.append(total * (min(n, EVIDENCE) / n) if n else total)
                evidence.append(n)
            logs = np.array(likelihood).reshape(len(evidence), len(names))
            alone = np.exp(logs - logs.max(axis=1, keepdims=True))
            alone /= alone.sum(axis=1, keepdims=True)
            offsets = pa.array(np.arange(len(evidence) + 1, dtype=np.int32) * len(names))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.ravel())) for x in (logs, alone)]
            rest = [batch.column(k) for k in ("kept", "declared", "host")]
            yield pa.RecordBatch.from_arrays(
                [*rest, *lists, pa.array(evidence, pa.int64())],
                names=["kept", "declared", "host", "likelihood", "alone", "evidence"],
            )

    counted = F.lit(None).cast("string")
    if key is not None and model.last:
        place = _place(F.xxhash64(key.cast("string")))
        for name, last in model.last.items():
            counted = F.when((primary_tag(declared) == name) & (place <= last), F.lit(name)).otherwise(counted)
    source = documents.select(
        F.struct(*[c.alias(k) for k, c in keep.items()]).alias("kept"), F.coalesce(primary_tag(declared), F.lower(declared)).alias("declared"),
        F.when(host != "", F.lower(host)).alias("host"), text.alias("text"), counted.alias("counted"),
    )
    kind = source.schema["kept"].dataType.simpleString()
    read = source.mapInArrow(score, f"kept {kind}, declared string, host string, likelihood array<double>, alone array<double>, evidence long")
    # Values that are no known language tell nothing that a table of bounded size could hold.
    known = F.col("declared").isin(model.languages)
    read = read.withColumn("declared", F.when(known, F.col("declared")).when(F.col("declared").isNotNull(), "other"))
    read = scratch.keep(read, "read")

    n = len(names)
    mix = [F.sum(F.when(F.col("evidence") > 0, F.col("alone")[k]).otherwise(F.lit(0.0))).alias(f"m{k}") for k in range(n)]
    whole = read.agg(*mix).first()
    mass = np.array([whole[k] or 0.0 for k in range(n)]) + 1.0
    base = [float(x) for x in mass / mass.sum()]
    by_declared = _table(read.filter("declared is not null").groupBy("declared").agg(*mix), "declared", n, _trust(model))
    suffixes = read.select(suffix_of(F.col("host")).alias("suffix"), "alone", "evidence").filter("suffix is not null")
    by_suffix = scratch.keep(suffixes.groupBy("suffix").agg(*mix), "suffixes")
    # Tasks sum their own rows of a host before the shuffle, so a large host is one row of each task.
    hosts = read.filter("host is not null").groupBy("host").agg(*mix)
    hosts = scratch.keep(hosts.withColumn("domain", domain_of(F.col("host"))), "hosts")
    sums = [F.sum(f"m{k}").alias(f"d{k}") for k in range(n)]
    domains = hosts.groupBy(F.col("domain").alias("of_domain")).agg(*sums)
    suffix_total = by_suffix.agg(*[F.sum(f"m{k}") for k in range(n)]).first()
    priors = hosts.join(domains, F.col("domain") == F.col("of_domain")).select(
        F.col("host").alias("of_host"), F.array(*[F.col(f"m{k}") for k in range(n)]).alias("host_mix"),
        F.array(*[F.col(f"d{k}") for k in range(n)]).alias("domain_mix"), suffix_of(F.col("host")).alias("suffix"),
    )
    # P(suffix | l), smoothed towards the suffix's share of the whole table.
    all_mass = sum(x or 0.0 for x in suffix_total)
    share = sum((F.col(f"m{k}") for k in range(n)), F.lit(0.0)) / F.lit(all_mass or 1.0)
    of_suffix = by_suffix.select(F.col("suffix").alias("of_suffix"), F.array(*[
        F.log((F.col(f"m{k}") + SMOOTHING * share + 1e-9) / F.lit((suffix_total[k] or 0.0) + SMOOTHING)) for k in range(n)
    ]).alias("suffix_log"))
    priors = priors.join(of_suffix, F.col("suffix") == F.col("of_suffix"), "left").select(
        "of_host", "host_mix", "domain_mix", "suffix_log"
    )
    priors = scratch.keep(priors, "priors")
    # A host may hold a third of all rows: the small side is repeated for each salt of the large one.
    salts = F.explode(F.sequence(F.lit(0), F.lit(HOST_SALTS - 1))).alias("of_salt")
    salted = read.withColumn("salt", F.pmod(F.xxhash64("kept", "likelihood"), F.lit(HOST_SALTS)).cast("int"))
    joined = salted.join(
        priors.select("*", salts), (F.col("host") == F.col("of_host")) & (F.col("salt") == F.col("of_salt")), "left"
    )
    own = lambda k: F.when(F.col("evidence") > 0, F.col("alone")[k]).otherwise(0.0)
    terms = []
    for k in range(n):
        others = lambda mixed, k=k: F.greatest(F.col(mixed)[k] - own(k), F.lit(0.0))
        size = lambda mixed: F.greatest(F.aggregate(mixed, F.lit(0.0), lambda a, x: a + x) - (F.col("evidence") > 0).cast("int"), F.lit(0.0))
        domain = (others("domain_mix") + SMOOTHING * base[k]) / (size("domain_mix") + SMOOTHING)
        prior = (others("host_mix") + SMOOTHING * domain) / (size("host_mix") + SMOOTHING)
        term = F.col("likelihood")[k] + F.log(F.coalesce(prior, F.lit(base[k]))) + F.coalesce(F.col("suffix_log")[k], F.lit(0.0))
        for value, logs in by_declared.items():
            term = term + F.when(F.col("declared") == value, F.lit(logs[k])).otherwise(0.0)
        terms.append(term)
    fused = joined.select("kept", "evidence", _normalised(F.array(*terms)).alias("fused"))
    best = F.array_max("fused")
    place = F.array_position("fused", best).cast("int")
    return fused.select(
        "kept.*", F.element_at(F.array(*[F.lit(x) for x in names]), place).alias("language"), F.round(best, 6).alias("posterior"),
        ((best >= threshold) & (F.col("evidence") > 0) & (place <= len(model.languages))).alias("accepted"),
    )


def accepted_documents(
    documents: DataFrame, model: TextModel, *, key: str = "doc_id", text: str = "text", declared: str = "lang",
    host: str = "source", threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents, with all their columns, whose language is accepted.

    Rows are told apart by key and text; the rejected ones are a narrow table, and its size on disk decides how it is
    joined.
    """
    scratch = Scratch(documents.sparkSession, "language-filter")
    same = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    judged = identify(
        documents, model, text=F.col(text), declared=F.col(declared), host=F.col(host), key=F.col(key), threshold=threshold,
        keep={"gone_key": F.col(key), "gone_text": same},
    )
    rejected = scratch.keep(judged.filter("not accepted").select("gone_key", "gone_text").distinct(), "rejected")
    rows = packed(documents, key=F.col(key), same=same)
    kept = rows.join(
        rejected, F.col("key").eqNullSafe(F.col("gone_key")) & (F.col("same") == F.col("gone_text")), "left_anti"
    )
    return unpacked(kept)


def _normalised(logs: Column) -> Column:
    top = F.array_max(logs)
    weights = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(weights, lambda x: x / F.aggregate(weights, F.lit(0.0), lambda a, w: a + w))


def _trust(model: TextModel) -> dict[str, np.ndarray]:
    """What is assumed of a declaration before any is seen: it is mostly right, and tells nothing of ``und``."""
    names, n = model.languages, len(model.languages)
    und = [1 / (n + 1)] * (len(model.classes) - n)
    spread = {v: np.array([0.9 if v == l else 0.1 / n for l in names] + und) for v in names}
    return {**spread, "other": np.array([0.1 / n] * n + und)}


def _table(sums: DataFrame, column: str, n: int, prior: dict[str, np.ndarray]) -> dict[str, list[float]]:
    """log P(value | l) from grouped sums; the values are the known languages and ``other``."""
    seen = {r[column]: np.array([r[f"m{k}"] or 0.0 for k in range(n)]) for r in sums.collect()}
    total = sum(seen.values(), np.zeros(n))
    return {
        value: [float(x) for x in np.log((seen.get(value, np.zeros(n)) + SMOOTHING * p) / (total + SMOOTHING))]
        for value, p in prior.items()
    }
