"""Groups of a sorted stream of batches, without holding more than one group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd


def groups_in_order(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Each run of rows with equal keys, also when it goes over several batches."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        key = pdf[keys].to_numpy()
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        if held and (held[-1][keys].iloc[-1].to_numpy() != key[0]).any():
            yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
            held = []
        edges = [0, *cuts.tolist(), len(pdf)]
        for a, b in zip(edges, edges[1:]):
            held.append(pdf.iloc[a:b])
            if b < len(pdf):
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
                held = []
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
