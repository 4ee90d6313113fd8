"""Settings of the engine, their defaults and bounds."""

from __future__ import annotations

from dataclasses import dataclass, fields

STRATEGIES = ("simple", "recursive", "semantic")
BOUNDS = {
    "chunk_size": (250, 2000), "chunk_overlap": (10, 300), "semantic_overlap": (1, 5), "max_chunk_tokens": (64, 512), "top_k": (1, None), "top_k_mmr": (1, None), "top_k_bm25": (1, None),
}


@dataclass(frozen=True)
class EngineConfig:
    """All settings; a value outside its bounds raises. An unknown strategy falls back to 'simple'. ``text_model`` names a
    registered embedding provider (``operators.embedding.register``)."""

    extract_images: bool = True
    image_store_folder: str = ""
    keep_chart_like: bool = True
    use_blip: bool = True
    use_chartqa: bool = True
    chunk_strategy: str = "simple"
    chunk_size: int = 1800
    chunk_overlap: int = 200
    semantic_overlap: int = 2
    max_chunk_tokens: int = 512
    text_model: str = "hash-64"
    base: str = "default"
    top_k: int = 3
    top_k_mmr: int = 20
    top_k_bm25: int = 10
    propagate_headings: bool = False
    drop_redundant_tail: bool = False
    dedupe_hybrid: bool = False

    def __post_init__(self):
        for f in fields(self):
            value, (low, high) = getattr(self, f.name), BOUNDS.get(f.name, (None, None))
            if low is not None and value < low or high is not None and value > high:
                raise ValueError(f"{f.name} must be from {low} to {high}")
        if not self.base.replace("_", "").isalnum():
            raise ValueError("base must be letters, digits and underscores")
        if self.chunk_strategy not in STRATEGIES:
            object.__setattr__(self, "chunk_strategy", "simple")

    def candidates(self) -> int:
        """Neighbours fetched per table."""
        return max(80, self.top_k_mmr + self.top_k_bm25 + 20)
