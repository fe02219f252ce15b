"""SentencePiece byte-pair encoding and decoding by vectorised merge rounds over all distinct words of a step."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame

from silsila.llm.bpe import MergeTable, merge_table, merge_words
from silsila.llm.common import map_rows, texts_of

SPACE = "▁"
_SEGMENT = re.compile(r" +[^ ]*")


@dataclass
class PieceModel:
    """What encoding and decoding need of a model file, as plain arrays."""
    char_id: np.ndarray            # code point -> symbol: a piece, or size + code point where there is none
    size: int                      # number of pieces
    table: dict                    # fields of the table of pairs that make pieces (equal scores share a rank)
    byte_id: list[int]
    raw: list[bytes]               # bytes a piece decodes to
    widest: int                    # longest piece of blanks only


def load_model(path: str) -> PieceModel:
    """Read a BPE model without text normalisation, with byte fallback, a leading blank and kept white space."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.vocab_size()
    special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
    names = [sp.id_to_piece(i) for i in range(n)]
    scores = np.array([sp.get_score(i) for i in range(n)])
    place = {p: i for i, p in enumerate(names) if not special[i]}
    order = np.unique(-scores[[i for i in range(n) if not special[i]]])
    pairs = [(place[p[:cut]], place[p[cut:]], i) for p, i in place.items() for cut in range(1, len(p))
             if p[:cut] in place and p[cut:] in place]
    left, right, out = map(list, zip(*pairs))
    table = merge_table(left, right, out, np.searchsorted(order, -scores[out]))
    char_id = np.arange(n, n + 0x110000, dtype=np.int32)
    for p, i in place.items():
        if len(p) == 1:
            char_id[ord(p)] = i
    char_id[ord(" ")] = char_id[ord(SPACE)]
    byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    raw = [p.replace(SPACE, " ").encode() for p in names]
    for b, i in enumerate(byte_id):
        raw[i] = bytes([b])
    for i in range(n):
        if sp.is_control(i):
            raw[i] = b""
    blanks = [len(p) for p in place if set(p) == {SPACE}]
    return PieceModel(char_id, n, vars(table), byte_id, raw, max(blanks))


def segments(text: str, widest: int) -> list[str]:
    """Words of a text, each without its first blank: no piece goes from a word into the blank after it.

    A run of blanks much longer than the longest piece of blanks is cut into runs of that length at its left, which is
    where leftmost merging completes them.
    """
    text = text.replace(SPACE, " ")
    if not text:
        return []
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    out = []
    for word in _SEGMENT.findall(" " + text):
        blanks = len(word) - len(word.lstrip(" "))
        if blanks > 4 * widest:
            n = (blanks - 2 * widest) // widest
            out += [" " * (widest - 1)] * n
            word = word[n * widest:]
        out.append(word[1:])
    return out


class PieceEncoder:
    """Encodes and decodes texts; each distinct word is merged once while it is remembered."""

    def __init__(self, model: PieceModel, remember: int = 250_000):
        self.model, self.remember, self.table = model, remember, MergeTable(**model.table)
        self.code: dict[str, int] = {}
        self.ids: list[str] = []
        self.size: list[int] = []
        self.decoded: list[str] = []

    def _learn(self, words: list[str]) -> None:
        m = self.model
        chars = np.frombuffer((SPACE + SPACE.join(words)).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        symbols, size = merge_words(self.table, m.char_id[chars], size)
        stops = np.cumsum(size).tolist()
        flat = symbols.tolist()
        low = 0
        for word, high in zip(words, stops):
            ids = flat[low:high]
            low = high
            if max(ids) >= m.size:                                    # characters without a piece become bytes
                ids = [j for i in ids for j in (
                    [i] if i < m.size else [m.byte_id[b] for b in chr(i - m.size).encode("utf-8", "surrogatepass")])]
            self.code[word] = len(self.ids)
            self.ids.append(",".join(map(str, ids)))
            self.size.append(len(ids))
            self.decoded.append(decode(m, ids))

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Per text: number of ids, ids joined by commas, the text decoded from the ids."""
        if len(self.code) > self.remember:
            self.__init__(self.model, self.remember)
        words = [segments(t, self.model.widest) for t in texts]
        new = [w for w in dict.fromkeys(w for some in words for w in some) if w not in self.code]
        if new:
            self._learn(new)
        out, code = [], self.code
        for some in words:
            at = [code[w] for w in some]
            # the first word's blank is the one encoding puts before every text
            out.append((sum(map(self.size.__getitem__, at)), ",".join(map(self.ids.__getitem__, at)),
                        "".join(map(self.decoded.__getitem__, at))[1:]))
        return out


def decode(model: PieceModel, ids: list[int]) -> str:
    """Text of ids, with the blank before it; byte pieces join to characters, broken ones become U+FFFD."""
    return b"".join(map(model.raw.__getitem__, ids)).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null text counts as empty and has no ids; repeated rows repeat; empty input gives no rows; a very long text is one
    step of its own; columns besides doc_id and text are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(vars(load_model(model_path)))   # one vocabulary, 20 MB
    held = []

    def one(batch):
        if not held:
            held.append(PieceEncoder(PieceModel(**model.value)))
        found = held[0].encode(texts_of(batch))
        return {"doc_id": batch.column("doc_id"), "n_tokens": [n for n, _, _ in found],
                "ids_sha256": [hashlib.sha256(ids.encode()).hexdigest() for _, ids, _ in found],
                "decoded_sha256": [hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest() for _, _, text in found]}

    return map_rows(docs.select("doc_id", "text"), one,
                    "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
