"""Defaults of the pipeline, as plain dataclasses passed by the caller."""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values ---------------------------------------------------------
CHUNK_TOKENS = 256
EMBEDDING_DIM = 384
MAX_SOURCE_BYTES = 512
MAX_TEXT_BYTES = 32768
STORED_ERROR_CHARS = 200
SHOWN_ERROR_CHARS = 80
SHOWN_ERRORS = 10
FILE_TIMEOUT_S = 600
PROGRESS_EVERY_S = 30
NLIST = 128
NPROBE = 16
TOP_K = 5
STATUSES = ("success", "empty", "error", "timeout")
# ---------------------------------------------------------------------------

#: Largest query or centroid matrix (as float64) that is shipped to every task.
BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class ChunkConfig:
    max_tokens: int = CHUNK_TOKENS
    index_mode: str = "position"  # or "dense"


@dataclass(frozen=True)
class ParseConfig:
    #: Tasks that parse: so many a worker (None: a core of the cluster), or more if there are many files.
    workers: int | None = None
    blocks_per_worker: int = 10
    files_per_task: int = 64
    timeout_s: float = FILE_TIMEOUT_S
    max_error_rate: float | None = None


@dataclass(frozen=True)
class CollectionConfig:
    name: str = "rag_documents"
    database: str = "default"
    dim: int = EMBEDDING_DIM
    max_text_bytes: int = MAX_TEXT_BYTES
    max_source_bytes: int = MAX_SOURCE_BYTES


@dataclass(frozen=True)
class SearchConfig:
    k: int = TOP_K
    nprobe: int = NPROBE
    broadcast_bytes: int = BROADCAST_BYTES
    #: Candidates that the tasks of a shipped search may hand in together.
    candidate_rows: int = 200_000_000
    #: Vectors held in memory per block, and queries that stream past one block,
    #: when the queries are too many to ship to every task.
    block_rows: int = 100_000
    block_queries: int = 1_000_000


@dataclass(frozen=True)
class GenerationConfig:
    max_tokens: int = 512
    temperature: float = 0.1
    timeout_s: float = 120.0
