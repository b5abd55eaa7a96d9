"""Token ids of whole texts by the tokenizers library, with the work on each distinct unit done once a batch run."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from ledgerloom.llm.common import kept_in_worker
from ledgerloom.llm.pretokens import BYTE_LETTERS, Gathered, Splitter, letter_units

# Units whose ids a task remembers; beyond it the memory starts anew.
REMEMBERED = 250_000
# Unknown units that go through the model in one call.
JOINED = 64


class ByteEncoder:
    """Encodes texts as the library does with a byte-level BPE file and add_special_tokens=False.

    Merges never cross the units of the vocabulary's pattern, so a task runs the library's model once for each distinct
    unit it meets. Units go through it many at a time, with the letter of a byte between them that no text and no merge of the file
    holds; in a file without such a letter, one at a time. A text with the string of an added token goes through the library whole.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.splitter = Splitter(leading_space=True, single_numbers=False)
        self.separator = self._separator()
        self.known: dict[str, bytes] = {}

    def _separator(self) -> tuple[str, int] | None:
        """A letter that stays a token of its own wherever it stands between two units, and its id."""
        model = json.loads(self.library.to_str())["model"]
        merged = set().union(*("".join(pair) for pair in model["merges"]))
        # Bytes that occur in no UTF-8 text.
        letters = (BYTE_LETTERS[byte] for byte in (0xFF, 0xFE, 0xFD, 0xFC, 0xFB, 0xFA, 0xF9, 0xF8, 0xC0, 0xC1))
        return next(((c, model["vocab"][c]) for c in letters if c in model["vocab"] and c not in merged), None)

    def _model_ids(self, units: list[str]) -> list[bytes]:
        """What the library's model makes of units of vocabulary letters: little-endian unsigned 32-bit ids."""
        tokenize = self.model.tokenize
        if self.separator is None:
            return [np.array([t.id for t in tokenize(unit)], "<u4").tobytes() for unit in units]
        letter, between = self.separator
        ids: list[int] = []
        for k in range(0, len(units), JOINED):
            ids += [t.id for t in tokenize(letter.join(units[k : k + JOINED]))]
            ids.append(between)
        coded = np.array(ids, "<u4")
        stops = np.flatnonzero(coded == between) * 4
        data, stops = coded.tobytes(), stops.tolist()
        return [data[a:b] for a, b in zip([0, *(s + 4 for s in stops)], stops)]

    def units(self, units: list[str]) -> list[bytes]:
        """The ids of each of some distinct units, which are given in vocabulary letters."""
        known = self.known
        if len(known) + len(units) > REMEMBERED:
            known.clear()
        found = list(map(known.get, units))
        new = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(new, self._model_ids([units[i] for i in new])):
            found[i] = known[units[i]] = ids
        return found

    def encode(self, values: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the number of ids before each text (one entry more)."""
        whole = {i: v for i, v in enumerate(values) if any(a in v for a in self.added)}
        units, before = self.splitter.split(["" if i in whole else v for i, v in enumerate(values)])
        coded = units.dictionary_encode()
        ids, starts = Gathered.of_bytes(self.units(letter_units(coded.dictionary))).take(
            coded.indices.to_numpy(zero_copy_only=False)
        )
        bounds = starts[before]
        if not whole:
            return ids, bounds
        parts = [
            np.array(self.library.encode(whole[i], add_special_tokens=False).ids, dtype=np.uint32)
            if i in whole
            else ids[bounds[i] : bounds[i + 1]]
            for i in range(len(values))
        ]
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])


def binaries(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary value for each range of ids: little-endian unsigned 32-bit integers."""
    data = np.ascontiguousarray(ids, dtype="<u4")
    offsets = pa.py_buffer((np.asarray(bounds, np.int64) * 4).astype(np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(data)]).cast(
        pa.binary()
    )


def byte_encoder(path: str) -> ByteEncoder:
    """The encoder of a Python worker: tasks that run in one process share what it remembers."""
    held = kept_in_worker()
    if path not in held:
        held[path] = ByteEncoder(path)
    return held[path]
