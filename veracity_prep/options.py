"""Settings of the text, image and split operators, as frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TextOptions:
    """How a text column is preprocessed.

    ``stemming`` takes precedence over ``lemmatization``; lemmatization needs a lexicon table and leaves
    tokens as they are without one. ``stopwords=None`` selects the built-in list of ``language``.
    """

    language: str = "english"
    remove_stopwords: bool = True
    stopwords: tuple[str, ...] | None = None
    stemming: bool = False
    lemmatization: bool = True
    max_length: int = 512
    split_contractions: bool = True


@dataclass(frozen=True)
class ImageOptions:
    """Target size (width, height) of resampled images."""

    resize: tuple[int, int] = (224, 224)


@dataclass(frozen=True)
class SplitOptions:
    """Proportions and seed of the train/validation/test splits and the number of folds.

    The seed is any integer: it salts the hash that orders the rows. ``rank_rows`` bounds how many rows of
    one group a single task ranks, whatever the size of the group.
    """

    val_size: float = 0.15
    test_size: float = 0.15
    n_folds: int = 5
    seed: int = -7
    cross_validation: bool = True
    drop_null_source: bool = False
    rank_rows: int = 1_000_000


@dataclass(frozen=True)
class Options:
    text: TextOptions = field(default_factory=TextOptions)
    image: ImageOptions = field(default_factory=ImageOptions)
    split: SplitOptions = field(default_factory=SplitOptions)
    #: Reactions kept with a thread.
    reaction_cut: int = 10
    #: Items of a list held in one row; the rows of a key, one after the other, are its list.
    list_rows: int = 100_000
    #: Buckets of the table of texts; 0 takes the number of shuffle partitions of the session.
    buckets: int = 0
