"""Near duplicates by MinHash signatures, banding, exact verification and components."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import PRIME, base_hashes, minhash, shingles
from millrace.functions.text import let
from millrace.operators.components import merge_components
from millrace.runtime import materialize, release


@dataclass(frozen=True)
class NearDuplicates:
    """Parameters of the operator.

    32 bands of 4 rows miss a pair of Jaccard similarity 0.8 with probability 5e-8. `exact` compares the sets of
    shingles of every candidate; without it the signatures' estimate decides.
    """

    shingle: int = 5
    permutations: int = 128
    bands: int = 32
    threshold: float = 0.8
    most_shingles: int | None = None
    exact: bool = True
    seed: int = 42
    block: int = 256

    def shingles(self) -> Column:
        """The shingles of `text`."""
        words = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
        return shingles(words, self.shingle, self.most_shingles)

    def hashed(self) -> Column:
        """64-bit hashes of the shingles of `text`."""
        return F.transform(self.shingles(), lambda s: F.xxhash64(s))

    def signatures(self, docs: DataFrame) -> DataFrame:
        """(id, signature) of docs(id, text), with `class_key`, which texts of equal shingles share, if `exact`; texts
        without words have a signature of zeros. Only without `exact` are the hashes those of the reference."""
        if not self.exact:
            return minhash(docs.select("id", base_hashes(self.shingles()).alias("hashes")), self.permutations, self.seed)
        low = lambda h: F.transform(h, lambda x: x.bitwiseAND(F.lit(PRIME))).alias("hashes")
        key = lambda h: F.sha2(F.array_join(F.array_sort(h).cast("array<string>"), ","), 256).alias("class_key")
        both = let(self.hashed(), lambda h: F.struct(low(h), key(h)))
        return minhash(docs.select("id", both.alias("both")).select("id", "both.hashes", "both.class_key"), self.permutations, self.seed, ["class_key"])

    def buckets(self, signatures: DataFrame) -> DataFrame:
        """(id, band, key) of every signature's bands."""
        rows = self.permutations // self.bands
        keys = F.transform(F.sequence(F.lit(0), F.lit(self.bands - 1)), lambda b: F.array_join(F.slice("signature", b * rows + 1, rows), ","))
        return signatures.select("id", F.posexplode(keys).alias("band", "key")).withColumn("key", F.xxhash64("key"))

    def candidates(self, buckets: DataFrame) -> DataFrame:
        """Distinct pairs (id1 < id2) that share a bucket.

        A bucket of more than `block` members is cut into blocks by a hash of the id, and pairs of blocks are joined
        instead of the bucket with itself. No pair is lost, and no task holds a whole hot bucket.
        """
        sizes = materialize(buckets.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1"), "bucket_sizes")
        blocks = F.ceil(F.col("n") / self.block).cast("int")
        member = buckets.join(sizes, ["band", "key"]).withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        spread = member.select("id", "band", "key", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        spread = spread.select("id", "band", "key", "own", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))
        on = ["band", "key", "p", "q"]
        pairs = spread.withColumnsRenamed({"id": "id1", "own": "own1"}).join(spread.withColumnsRenamed({"id": "id2", "own": "own2"}), on)
        across = (F.least("own1", "own2") == F.col("p")) & (F.greatest("own1", "own2") == F.col("q"))
        return pairs.filter((F.col("id1") < F.col("id2")) & across).select("id1", "id2").distinct()

    def edges(self, candidates: DataFrame, signatures: DataFrame) -> DataFrame:
        """Candidates whose signatures agree in at least `threshold` of the places, with their similarity."""
        a = signatures.select(F.col("id").alias("id1"), F.col("signature").alias("s1"))
        b = signatures.select(F.col("id").alias("id2"), F.col("signature").alias("s2"))
        same = F.size(F.filter(F.zip_with("s1", "s2", lambda x, y: x == y), lambda x: x)) / float(self.permutations)
        return candidates.join(a, "id1").join(b, "id2").select("id1", "id2", same.alias("similarity")).filter(F.col("similarity") >= self.threshold)

    def verified(self, candidates: DataFrame, docs: DataFrame) -> DataFrame:
        """Candidates whose sets of shingles, as 64-bit hashes, have a Jaccard similarity of at least `threshold`.

        Pairs whose sizes alone rule that out are dropped before the sets are joined.
        """
        used = candidates.select(F.explode(F.array("id1", "id2")).alias("id")).distinct()
        sets = docs.join(used, "id", "left_semi").select("id", self.hashed().alias("items"))
        sets = materialize(sets.withColumn("n", F.size("items")), "shingle_sets")
        for i in ("1", "2"):
            candidates = candidates.join(sets.select(F.col("id").alias(f"id{i}"), F.col("n").alias(f"n{i}")), f"id{i}")
        near = candidates.filter(F.least("n1", "n2") >= F.greatest("n1", "n2") * self.threshold - 1e-6)
        for i in ("1", "2"):
            near = near.join(sets.select(F.col("id").alias(f"id{i}"), F.col("items").alias(f"items{i}")), f"id{i}")
        both = F.size(F.array_intersect("items1", "items2"))
        near = near.select("id1", "id2", "n1", "n2", both.alias("both"))
        return near.select("id1", "id2", (F.col("both") / (F.col("n1") + F.col("n2") - F.col("both"))).alias("similarity")).filter(F.col("similarity") >= self.threshold)

    def run(self, docs: DataFrame) -> DataFrame:
        """docs(id, text, score) with `cluster` (smallest id of the component), `canonical`, `kept` and `similarity`.

        Texts with equal shingles (equal signatures if not `exact`) are one class, represented by its smallest id; only representatives are banded,
        paired and linked, and the other members join their class again at the end. In a component the document of
        highest score is kept, then the longest, then the smallest id. `similarity` is the mean similarity of the
        removed documents to the kept one, where those not linked to it directly count with the threshold. A document
        without near duplicates is its own cluster with a null similarity.
        """
        signed = materialize(self.signatures(docs), "signatures")
        key = signed.select("id", F.col("class_key") if self.exact else F.sha2(F.array_join("signature", ","), 256).alias("class_key"))
        heads = key.groupBy("class_key").agg(F.min("id").alias("head"))
        classes = materialize(key.join(heads, "class_key").select("id", "head"), "classes")
        distinct = signed.select("id", "signature").join(classes.filter("id = head").select("id"), "id", "left_semi")
        if self.exact:
            distinct = materialize(distinct, "heads")
            release(signed)
            found = materialize(self.candidates(self.buckets(distinct)), "candidates")
            release(distinct)
            edges = materialize(self.verified(found, docs), "edges")
        else:
            edges = materialize(self.edges(self.candidates(self.buckets(distinct)), distinct), "edges")
        parts = merge_components(None, edges.select(F.col("id1").alias("u"), F.col("id2").alias("v")))
        member = classes.join(parts.withColumnsRenamed({"node": "head"}), "head", "left").select("id", "head", F.coalesce("component", "head").alias("cluster"))
        slim = member.join(docs.select("id", F.coalesce("score", F.lit(0.0)).alias("score"), F.length("text").alias("length")), "id")
        best = slim.groupBy("cluster").agg(
            F.min(F.struct((-F.col("score")).alias("s"), (-F.col("length")).alias("l"), F.col("id"), F.col("head"))).alias("best"), F.count("*").alias("n")
        )
        both = slim.join(best, "cluster").withColumn("kept", F.col("id") == F.col("best.id"))
        pair = edges.select(F.col("id1").alias("p"), F.col("id2").alias("q"), "similarity")
        x = F.least("head", F.col("best.head"))
        y = F.greatest("head", F.col("best.head"))
        linked = both.withColumn("p", x).withColumn("q", y).join(pair, ["p", "q"], "left")
        own = F.when(F.col("p") == F.col("q"), 1.0).otherwise(F.coalesce("similarity", F.lit(self.threshold)))
        judged = linked.select("id", "cluster", F.col("best.id").alias("canonical"), "kept", own.alias("own"))
        mean = judged.filter(~F.col("kept")).groupBy("cluster").agg(F.round(F.avg("own"), 4).alias("similarity"))
        return judged.drop("own").join(mean, "cluster", "left").select("id", "cluster", "canonical", "kept", "similarity")


#: The parameters of the reference, which samples texts of more than about a thousand words; its SQL has the same.
REFERENCE = NearDuplicates(bands=16, threshold=0.85, most_shingles=512, exact=False)
