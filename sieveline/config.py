"""Defaults and size bounds.

Values under "fixed values" are parameters whose defaults decide the results;
every operator takes them as arguments, so a caller can override any of them.
"""

from __future__ import annotations

# Default parameters.
MAX_TOKENS = 180
STRIDE = 40
TOPK_DENSE = 100
TOPK_BM25 = 100
K_FUSION = 100
RRF_K = 60
RERANK_CAP = 50
CONFIDENCE_THRESHOLD = 0.45
SIMILARITY_THRESHOLD = 0.90
SENTENCE_THRESHOLD = 0.70
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25
BASE_SEED = 42
TOPK_PASSAGES = 5
CONDITIONS = (
    "normal",
    "no_retrieval",
    "swapped_context",
    "random_in_domain",
    "shuffled_order",
    "corrupted_context",
)
CONTENT_SWAP_CONDITIONS = ("swapped_context", "random_in_domain")

# Chunks of one slab of a lexical index: what a task scores at once.
SLAB_CHUNKS = 16_384

# Size bounds for broadcasts. A side is broadcast only after a count showed
# that it is within its bound; a larger one goes through in blocks.
MAX_BROADCAST_TERM_ROWS = 400_000
MAX_BROADCAST_VECTOR_CELLS = 16_000_000  # float32 values, 64 MB
# A task that scores blocks keeps k running scores per query: at most this many.
MAX_RUNNING_SCORES = 16_000_000  # float64 values, 128 MB

# Hex characters of an md5 used as a rank bucket: 16**3 = 4096 buckets.
HASH_BUCKET_CHARS = 3
