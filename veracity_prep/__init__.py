"""Preparation of labelled multimodal veracity corpora, written as Spark DataFrame transformations."""

from veracity_prep.options import ImageOptions, Options, SplitOptions, TextOptions

__all__ = ["ImageOptions", "Options", "SplitOptions", "TextOptions"]
