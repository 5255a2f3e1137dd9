"""Column-level functions: text expressions, clipping, and two Arrow helpers."""

from .clip import clip_both, clip_upper
from .text import (alpha_tokens, concat_cols, contains_text, fill_text, first_words,
                   nan_text, normalise, overlap_count, pack, sentences, unpack,
                   word_count, word_tokens, words)

__all__ = ["clip_both", "clip_upper", "alpha_tokens", "concat_cols", "contains_text",
           "fill_text", "first_words", "nan_text", "normalise", "overlap_count", "pack",
           "sentences", "unpack", "word_count", "word_tokens", "words"]
