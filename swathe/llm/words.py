"""Words of whole Arrow columns: runs of anything but ASCII white space."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Text number and word number of every word, in order, and the distinct words.

    A null text has no words.
    """
    lists = pc.ascii_split_whitespace(texts)
    of_text = np.repeat(np.arange(len(texts)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    coded = lists.flatten().dictionary_encode()
    codes, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    empty = pc.index(words, "").as_py()
    if empty >= 0:  # before and after outer white space
        stays = codes != empty
        of_text, codes = of_text[stays], codes[stays]
        codes = codes - (codes > empty)
        words = pa.concat_arrays([words[:empty], words[empty + 1 :]])
    return of_text, codes, words


def large_strings(column: pa.Array) -> pa.Array:
    """A string column whose words may fill more than two gigabytes."""
    return column.cast(pa.large_string())
