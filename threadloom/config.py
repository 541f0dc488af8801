"""Run configuration as frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PullConfig:
    """Switches of the ingest filters."""

    months_back: int = 12
    subreddits: tuple[str, ...] = ()
    per_subreddit_posts: int = 25
    top_k: int = 3
    min_len: int = 10
    english_only: bool = True
    exclude_nsfw: bool = True
    exclude_removed: bool = True
    drop_author: bool = True

    @staticmethod
    def from_dict(raw: dict) -> "PullConfig":
        """Build from the nested mapping a YAML or JSON config file parses to."""
        comments = raw.get("comments", {})
        filters = raw.get("filters", {})
        return PullConfig(
            months_back=raw.get("time_range", {}).get("months_back", 12),
            subreddits=tuple(raw.get("subreddits", ())),
            per_subreddit_posts=raw.get("per_subreddit_posts", 25),
            top_k=comments.get("top_k", 3),
            min_len=comments.get("min_len", 10),
            english_only=filters.get("english_only", True),
            exclude_nsfw=filters.get("exclude_nsfw", True),
            exclude_removed=filters.get("exclude_removed", True),
            drop_author=raw.get("privacy", {}).get("drop_author", True),
        )


@dataclass(frozen=True)
class VocabConfig:
    """Vocabulary selection; ``max_df`` is a fraction of documents.

    ``min_df`` below 1.0 given as a float is a fraction too.
    """

    ngram_lo: int = 1
    ngram_hi: int = 2
    min_df: float = 12
    max_df: float = 0.40
    max_features: int = 10000


@dataclass(frozen=True)
class NmfConfig:
    """Topic factorisation settings (Kullback-Leibler, multiplicative)."""

    k: int = 15
    alpha_w: float = 0.0
    alpha_h: float = 0.1
    l1_ratio: float = 0.7
    max_iter: int = 1500
    tol: float = 1e-4
    inner_steps: int = 15
    seed: int = 42


BASELINE_VOCAB = VocabConfig(min_df=20, max_df=0.5, max_features=20000)
BASELINE_NMF = NmfConfig(alpha_h=0.0, l1_ratio=0.0, max_iter=800)


@dataclass(frozen=True)
class LogRegGrid:
    """Grid of the logistic-regression search."""

    cs: tuple[float, ...] = (0.01, 0.03, 0.1, 0.3, 1, 3, 10)
    penalties: tuple[str, ...] = ("l2", "l1")
    folds: int = 5
    repeats: int = 2
    max_iter: int = 4000
    seed: int = 42


@dataclass(frozen=True)
class ForestConfig:
    """Random-forest settings; depth 30 is the deepest Spark grows."""

    trees: int = 600
    max_depth: int = 30
    min_leaf: int = 2
    seed: int = 42


@dataclass(frozen=True)
class FeatureBlocks:
    """Which blocks enter the feature vector."""

    tfidf: bool = True
    topics: bool = True
    meta: bool = True
    log_length: bool = True
    scale_meta: bool = True
    fit_on: str = "all"


PULL_DEFAULT = PullConfig()
VOCAB_DEFAULT = VocabConfig()
NMF_DEFAULT = NmfConfig()
GRID_DEFAULT = LogRegGrid()
FOREST_DEFAULT = ForestConfig()
BLOCKS_DEFAULT = FeatureBlocks()

