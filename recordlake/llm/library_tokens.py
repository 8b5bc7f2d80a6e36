"""Token ids as the tokenizers library gives them, each distinct chunk of text encoded once."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The characters that stand for space and line feed in byte-level vocabularies.
SPACE, LINE_FEED = "Ġ", "Ċ"
#: White space of any kind, two of which side by side share a piece; for RE2, whose own \s is ASCII.
WHITE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
ADJACENT, FIRST = WHITE + "{2}", "^" + WHITE
#: Characters of a chunk that is remembered at most, and chunks that a worker remembers.
CHUNK, REMEMBERED = 48, 800_000
#: Words that the library gets as one text.
JOINED = 1000
#: Signs that never share a piece with a letter before them, and letters of which that is known.
SIGNS, LETTERS = ".,;:!?|)\"", "ɏ"
GAP = re.compile(r"\s")


class LibraryEncoder:
    """A byte-level vocabulary without a normaliser, cut by the pattern that such vocabularies share.

    By that pattern no piece reaches over a place where white space follows other characters, and
    what is looked at beyond a piece is no more than the white space there. So a text without
    adjacent white space is cut before every space and line feed, and its chunks are encoded
    apart. All other texts go to the library as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark shares the cores out
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocabulary = self.library.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True
        self.line_feed = vocabulary[LINE_FEED]
        self.known: dict[str, bytes] = {}
        self.once: set[str] = set()
        self.signs: dict[str, bytes] = {}

    def encoded(self, texts: list[str]) -> list[bytes]:
        """Ids of each text by the library, in little-endian 32-bit numbers."""
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def encoded_chunks(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks: one that begins with a line feed as it is, any other after a space.

        Many are encoded as one text, in which each begins where a token begins with a space, or
        at a line feed.
        """
        made: dict[str, bytes] = {}
        lines = [p for p in chunks if len(p) > 1 and p[0] == "\n"]
        words = [p for p in chunks if p and p[0] != "\n"]
        if GAP.search("".join(words)) or GAP.search("".join([p[1:] for p in lines])):
            lines = [p for p in lines if not GAP.search(p, 1)]
            words = [p for p in words if not GAP.search(p)]
        for plain, glue, lead in ((words, " ", " "), (lines, "", "")):
            groups = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
            for group, data in zip(groups, self.encoded([lead + glue.join(g) for g in groups])):
                ids = np.frombuffer(data, "<u4")
                begins = self.spaced[ids] if lead else ids == self.line_feed
                first = (4 * np.flatnonzero(begins)).tolist()
                made.update(zip(group, [data[a:b] for a, b in zip(first, [*first[1:], len(data)])]))
        if len(made) < len(chunks):
            others = [p for p in chunks if p not in made]
            made.update(zip(others, self.encoded([p if p.startswith("\n") else " " + p for p in others])))
        return made

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks; signs behind a letter are cut off, so that a word is encoded once."""
        known, signs, cut, fresh, new_signs = self.known, self.signs, [], [], set()
        for p in chunks:
            word = p.rstrip(SIGNS)
            if len(word) == len(p) or not word or not word[-1].isalpha() or word[-1] > LETTERS:
                fresh.append(p)
                continue
            end = p[len(word) :]
            cut.append((p, word, end))
            if word not in known:
                fresh.append(word)
            if end not in signs:
                new_signs.add(end)
        made = self.encoded_chunks(list(dict.fromkeys(fresh)))
        known.update(made)
        self.once.update(made)
        new = sorted(new_signs)
        signs.update(zip(new, self.encoded(new)))
        known.update((p, known[word] + signs[end]) for p, word, end in cut)
        if len(signs) > REMEMBERED:
            signs.clear()

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids end; null is empty."""
        texts = pc.fill_null(texts, "")
        whole = pc.or_(pc.match_substring_regex(texts, ADJACENT), pc.match_substring_regex(texts, FIRST))
        whole = pc.or_(whole, pc.equal(texts, ""))
        for special in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, special))
        alone = whole.to_numpy(zero_copy_only=False)
        plain_ids, plain_counts = self.encode_plain(texts.filter(pc.invert(whole)))
        if not alone.any():
            return plain_ids, np.cumsum(plain_counts)
        counts = np.zeros(len(alone), np.int64)
        counts[~alone] = plain_counts
        odd = self.encoded(texts.filter(whole).to_pylist())
        counts[alone] = [len(ids) // 4 for ids in odd]
        ids = np.empty(int(counts.sum()), "<u4")
        owner = np.repeat(alone, counts)
        ids[~owner], ids[owner] = plain_ids, np.frombuffer(b"".join(odd), "<u4")
        return ids, np.cumsum(counts)

    def encode_plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without adjacent white space, that begin with none, and how many each has."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        # A line feed before each text makes its first chunk one like others; it is dropped again.
        lines = pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), "")
        cut = pc.split_pattern(lines, " ")
        chunks = cut.flatten().dictionary_encode()
        known, distinct = self.known, chunks.dictionary.to_pylist()
        self.once.difference_update(distinct)
        fresh = [p for p in distinct if p not in known]
        self.learn(fresh)
        values = pa.array(list(map(known.__getitem__, distinct)), pa.binary()).take(chunks.indices)
        offsets = np.frombuffer(values.buffers()[1], "<i4", len(values) + 1, 4 * values.offset)
        ids = np.frombuffer(values.buffers()[2], "<u4", int(offsets[-1]) // 4)
        last = offsets[np.cumsum(pc.list_value_length(cut).to_numpy())].astype(np.int64) // 4
        counts = np.diff(last, prepend=0)
        left = np.ones(len(ids), bool)
        left[last - counts] = False
        self.once.update(fresh)
        for p in fresh:
            if len(p) > CHUNK:
                del known[p]
        if len(known) > REMEMBERED:
            self.forget()
        return ids[left], counts - 1

    def forget(self) -> None:
        """Chunks that came once are forgotten, or all if that is not enough."""
        for p in self.once:
            self.known.pop(p, None)
        self.once.clear()
        if len(self.known) > REMEMBERED // 2:
            self.known.clear()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text in little-endian 32-bit numbers; null is empty."""
        ids, ends = self.encode_array(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip([0, *ends.tolist()], ends.tolist())]


@lru_cache(maxsize=2)
def encoder(path: str) -> LibraryEncoder:
    """One per worker and vocabulary."""
    return LibraryEncoder(path)
