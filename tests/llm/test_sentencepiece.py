import random

import numpy as np
import public_tokenizers
from sentencepiece import SentencePieceProcessor

from cohortgrid.llm.sentencepiece_viterbi import Encoder, decode, decode_ids, encode
from llm.conftest import odd_rows, prose

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def brute_force(text, model, index, unknown):
    """Best score sums character by character, for one text as a whole."""
    marked = "▁" + text.replace(" ", "▁")
    best = [0.0] + [-np.inf] * len(marked)
    for end in range(1, len(marked) + 1):
        for start in range(max(0, end - 16), end):
            piece = marked[start:end]
            if piece in index:
                best[end] = max(best[end], best[start] + index[piece])
            elif end - start == 1:
                best[end] = max(best[end], best[start] + unknown)
    return best[-1]


def test_best_scores_and_round_trip():
    model, encoder, r = SentencePieceProcessor(model_file=MODEL), Encoder(MODEL), random.Random(2)
    normal = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    index = {model.id_to_piece(i): model.get_score(i) for i in normal}
    unknown = min(index.values()) - 10
    parts = ["a", "the", " ", "  ", "\n", "é", "ing", "漢", "😀", "１", "zq", "tion", "\t", "...", "123"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(1, 20))) for _ in range(300)] + [prose(1, 30), "x" * 70]
    for text, code in zip(texts, encoder(texts), strict=True):
        ids = np.frombuffer(code, "<i4").tolist()
        assert decode_ids(ids, encoder.pieces) == text
        at, total = 0, 0.0
        while at < len(ids):  # a run of byte pieces is one character
            if model.is_byte(ids[at]):
                lead = int(model.id_to_piece(ids[at])[3:5], 16)
                at += 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                total += unknown
            else:
                total += index[model.id_to_piece(ids[at])]
                at += 1
        assert total == brute_force(text, model, index, unknown)


def test_pieces_of_ties_and_literal_marks():
    encoder = Encoder(MODEL)
    texts = ["▁", "a▁b", " ▁ ", "", " ", "   ", "\u0000", "\x85"]
    for text, code in zip(texts, encoder(texts), strict=True):
        assert decode_ids(np.frombuffer(code, "<i4").tolist(), encoder.pieces) == text


def test_odd_rows(odd, no_documents):
    coded = encode(odd, MODEL, check=True)
    rows = coded.collect()
    assert all(r["round_trip"] for r in rows) and len(rows) == len(odd_rows())
    back = sorted(((r["doc_id"], r["text"]) for r in decode(coded, MODEL).collect()), key=str)
    assert back == sorted(((r[0], r[1] or "") for r in odd_rows()), key=str)
    assert encode(no_documents, MODEL).count() == 0 and decode(encode(no_documents, MODEL), MODEL).count() == 0
