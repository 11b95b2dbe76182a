"""Byte-level BPE as a streaming transducer with bounded look-ahead, and its decoder.

`Transducer` reads a text in pieces of `CHUNK` characters and holds at most one unfinished
pre-token plus `LOOKAHEAD` characters besides the piece: a pre-token (a match of the vocabulary's
split pattern) is final once `LOOKAHEAD` more characters are seen, because every alternative of the
pattern stops at, or looks at, no more than two characters past its end. Inside a pre-token, merges
apply by rank, lowest first and leftmost among equals. A pre-token longer than `CHUNK` characters
(a text without blanks) goes through `_stable_prefix_tokens`: the last token of every prefix is
known from the prefix alone, and a token is emitted once the chains of last tokens that start at
every position of the final `span` bytes (span: the longest token, in bytes, of the merge list)
meet before it, as no later input can then change it. Memory is bounded by the piece, the span
and the merge list.

`decode_stream` turns ids back into text with an incremental UTF-8 state machine: bytes of a
character split over tokens are held until the character is whole; bytes that never make a
character become U+FFFD per maximal bad part, as the reference library's lossy decoding does.

Edge cases: a null or empty text has no tokens; the special token's text in a document is the
special id, as the tokenizers library does by default; decoding keeps special tokens.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache

import regex

#: Characters read at a time; a pre-token is final once this many characters past its end are read.
CHUNK = 1 << 16
LOOKAHEAD = 2
#: Pre-tokens whose ids a Python worker keeps (about 150 bytes each); the table is emptied when full.
WORDS_HELD = 1 << 20
#: Pre-tokens of more characters than this are merged by the streaming rule instead of whole.
LONG = 256


def _byte_alphabet():
    """The printable stand-in of each byte used by byte-level vocabularies (a published rule)."""
    keep = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    chars, extra = {}, 0
    for b in range(256):
        if b in keep:
            chars[b] = chr(b)
        else:
            chars[b] = chr(256 + extra)
            extra += 1
    return chars


class Vocabulary:
    """Ids, ranks of merges and special tokens of one tokenizers JSON file."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids = dict(model["vocab"])
        self.tokens = {i: t for t, i in self.ids.items()}
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: r for r, pair in enumerate(merges)}
        self.special = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        for content, i in self.special.items():
            self.tokens[i] = content
        self.byte_char = _byte_alphabet()
        self.char_byte = {c: b for b, c in self.byte_char.items()}
        self.byte_table = {b: c for b, c in self.byte_char.items()}
        # The longest token in bytes bounds how far back a new byte can change the last tokens.
        self.span = max(len(t) for t in self.ids)
        self.suffixes = {t[i:] for t in self.ids for i in range(len(t))}
        pattern = spec.get("pre_tokenizer", {}) or {}
        if pattern.get("type") != "ByteLevel" or pattern.get("add_prefix_space"):
            raise ValueError("only byte-level vocabularies without a prefix space are handled")
        self.split = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
        self.special_split = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self._cache = lru_cache(maxsize=1 << 16)(self._merge_word)
        self._words = {}  # pre-token text -> ids, emptied when full
        self.known = self._words.get
        self.id_bytes = [b""] * (max(self.tokens) + 1)
        self.id_text = [str(i) for i in range(len(self.id_bytes))]
        for i, token in self.tokens.items():
            special = token in self.special and self.special[token] == i
            self.id_bytes[i] = token.encode("utf-8") if special else bytes(self.char_byte[c] for c in token)

    def _merge_word(self, word: str) -> tuple[int, ...]:
        """Ids of one byte-level pre-token: merge the pair of lowest rank until none is left."""
        parts = list(word)
        ranks, never = self.ranks, len(self.ranks)
        while len(parts) > 1:
            found = [ranks.get(pair, never) for pair in zip(parts, parts[1:])]
            best = min(found)
            if best == never:
                break
            at = found.index(best)
            left, right = parts[at], parts[at + 1]
            merged, i = parts[:at], at
            while i < len(parts):
                if i < len(parts) - 1 and parts[i] == left and parts[i + 1] == right:
                    merged.append(left + right)
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return tuple([self.ids[p] for p in parts])

    def word_ids(self, piece: str):
        """Ids of one pre-token given as text."""
        known = self._words.get(piece)
        if known is not None:
            return known
        mapped = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.byte_table)
        if len(mapped) > LONG:
            return tuple(_stable_prefix_tokens(self, mapped))
        if len(self._words) >= WORDS_HELD:
            self._words.clear()
        known = self._words[piece] = self._merge_word(mapped)
        return known


def _stable_prefix_tokens(vocab: Vocabulary, chars: str):
    """Ids of one long pre-token, emitted as they become final; see the module notes.

    last[i] is the last token of the encoding of chars[:i]: the longest token t ending at i whose
    pair with last[i - len(t)] is what merging the two tokens' text alone gives. Every `span`
    characters, the chains of last tokens from the newest `span` positions are followed back to
    where they all meet; the tokens before that point are final and given out.
    """
    span, ids, suffixes = vocab.span, vocab.ids, vocab.suffixes
    last = {0: ("", 0)}  # position -> (token text, start)
    emitted = 0

    def fits(before, token):
        return not before or vocab._cache(before + token) == (ids[before], ids[token])

    def give(meet):
        chain, at = [], meet
        while at > emitted:
            token, start = last[at]
            chain.append(ids[token])
            at = start
        return chain[::-1]

    n = len(chars)
    for end in range(1, n + 1):
        length, found = 1, []
        while length <= end and length <= span and chars[end - length:end] in suffixes:
            if chars[end - length:end] in ids:
                found.append(length)
            length += 1
        for length in reversed(found):
            start = end - length
            if start in last and fits(last[start][0], chars[start:end]):
                last[end] = (chars[start:end], start)
                break
        else:
            raise ValueError("no token fits; the merge list is not a byte-level BPE one")
        if end % span == 0 and end - emitted > 2 * span:
            meet = _meeting(last, end - span + 1, end)
            yield from give(meet)
            for position in [p for p in last if p < meet]:
                del last[position]
            emitted = meet
    yield from give(n)


def _meeting(last, low, end):
    """The position that the chains of last tokens from every position in [low, end] all reach first."""
    heap = [-p for p in range(low, end + 1)]
    heapq.heapify(heap)
    members = set(range(low, end + 1))
    while len(members) > 1:
        top = -heapq.heappop(heap)
        members.discard(top)
        parent = last[top][1]
        if parent not in members:
            members.add(parent)
            heapq.heappush(heap, -parent)
    return members.pop()


class Transducer:
    """Ids of a text, given piece by piece; holds no more than the open pre-token and the look-ahead."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab

    def encode(self, text: str | None):
        """Ids of `text`, one at a time."""
        for ids in self.encode_blocks(text):
            yield from ids

    def encode_blocks(self, text: str | None):
        """Ids of `text` as lists, one per special token or piece read."""
        if not text:
            return
        vocab = self.vocab
        pieces = [(False, text)]
        if vocab.special_split is not None:
            pieces, at = [], 0
            for m in vocab.special_split.finditer(text):
                if m.start() > at:
                    pieces.append((False, text[at:m.start()]))
                pieces.append((True, m.group()))
                at = m.end()
            if at < len(text):
                pieces.append((False, text[at:]))
        for special, piece in pieces:
            if special:
                yield [vocab.special[piece]]
            else:
                yield from self._plain(piece)

    def _plain(self, text):
        vocab = self.vocab
        buffer, read = "", 0
        while True:
            piece = text[read:read + CHUNK]
            read += len(piece)
            buffer += piece
            final = read >= len(text)
            if final:
                found = vocab.split.findall(buffer)
            else:
                found, done = [], 0
                for m in vocab.split.finditer(buffer):
                    if m.end() + LOOKAHEAD > len(buffer):
                        break
                    found.append(m.group())
                    done = m.end()
                buffer = buffer[done:]
            ids = []
            for word in found:
                known = vocab.known(word)
                ids += vocab.word_ids(word) if known is None else known
            yield ids
            if final:
                return


def decode_stream(vocab: Vocabulary, ids, block=4096):
    """Text pieces of `ids`, each given once its characters are whole (UTF-8 state machine).

    Ids are read `block` at a time; the bytes of an unfinished character at the end of a block
    are the machine's state and wait for the next block.
    """
    held = b""
    table = vocab.id_bytes
    batch = []
    for i in ids:
        batch.append(i)
        if len(batch) >= block:
            held += b"".join(table[j] for j in batch)
            batch.clear()
            cut = _whole_prefix(held)
            if cut:
                yield held[:cut].decode("utf-8", "replace")
                held = held[cut:]
    held += b"".join(table[j] for j in batch)
    if held:
        yield held.decode("utf-8", "replace")


def decode_blocks(vocab: Vocabulary, blocks):
    """As `decode_stream`, for ids given as lists."""
    held = b""
    table = vocab.id_bytes
    for block in blocks:
        held += b"".join([table[j] for j in block])
        cut = _whole_prefix(held)
        if cut:
            yield held[:cut].decode("utf-8", "replace")
            held = held[cut:]
    if held:
        yield held.decode("utf-8", "replace")


def _whole_prefix(data: bytes) -> int:
    """Length of the longest prefix of `data` that ends outside a possibly unfinished character."""
    n = len(data)
    back = 0
    while back < min(3, n) and 0x80 <= data[n - 1 - back] < 0xC0:
        back += 1
    if back == n:
        return n if back >= 3 else 0
    lead = data[n - 1 - back]
    need = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 1
    if need > back + 1:
        return n - 1 - back
    return n


@lru_cache(maxsize=4)
def vocabulary(path) -> Vocabulary:
    return Vocabulary(path)


def digest(vocab: Vocabulary, text: str | None):
    """(n_tokens, sha256 of the decimal ids joined by commas, sha256 of the decoded text)."""
    ids_hash, text_hash = hashlib.sha256(), hashlib.sha256()
    count, decimal = 0, vocab.id_text

    def ids():
        nonlocal count
        for block in Transducer(vocab).encode_blocks(text):
            if block:
                ids_hash.update(((b"," if count else b"") + ",".join([decimal[i] for i in block]).encode()))
                count += len(block)
                yield block

    for piece in decode_blocks(vocab, ids()):
        text_hash.update(piece.encode("utf-8", "surrogatepass"))
    return count, ids_hash.hexdigest(), text_hash.hexdigest()


def encode_documents(docs, tokenizer_path, id_col="doc_id", text_col="text"):
    """Per row of `docs`: its id, n_tokens, ids_sha256 and decoded_sha256 of the round trip.

    Rows stay where they are (no shuffle); Python workers get whole texts a few hundred at a time.
    Null and empty texts give 0 tokens and the hashes of empty input; repeated rows give repeated
    results; other columns of `docs` are not read, whatever their names.
    """
    import pandas as pd

    from bookbase.llm.common import small_batches

    small_batches(docs.sparkSession)
    schema = f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(frames):
        vocab = vocabulary(tokenizer_path)
        for frame in frames:
            rows = [digest(vocab, t) for t in frame[text_col]]
            yield pd.DataFrame({
                id_col: frame[id_col].astype("Int64"),
                "n_tokens": pd.Series([r[0] for r in rows], dtype="int64"),
                "ids_sha256": [r[1] for r in rows],
                "decoded_sha256": [r[2] for r in rows],
            })

    return docs.select(id_col, text_col).mapInPandas(run, schema)
