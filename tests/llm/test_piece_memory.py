"""What the last step of giant texts holds at once."""

from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa
import sentencepiece

from saldo.llm import piece_scan


def test_ids_of_giants_leave_some_chunks_at_a_time():
    """Ids of a batch of chunks are never Python lists or one frame together: what is held does not grow with the batch."""
    pieces, rnd, size = piece_scan.loaded(piece_scan.read_model()), random.Random(6), 2048
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9))) for _ in range(500)]
    library, peaks = sentencepiece.SentencePieceProcessor(model_file=piece_scan.MODEL), []
    for chunks in (16, 256):
        text = " ".join(rnd.choice(words) for _ in range(chunks * size // 6))
        parts = [(i, n, b, lo, hi) for i, n, b, lo, hi in piece_scan.cut(pieces.escaped(text), size, pieces.longest)]
        states = piece_scan.cut_states([piece_scan.Chunk(pieces, b, lo, hi, i == 0, i == n - 1).matrix() for i, n, b, lo, hi in parts])
        batch = pa.RecordBatch.from_pylist([
            {"row": 7, "part": i, "parts": n, "body": b, "low": lo, "high": hi, "entry": states[i], "exit": states[i + 1]}
            for i, n, b, lo, hi in parts
        ])
        got = list(piece_scan.traced(pieces, batch, 8))
        assert [i for b in got for x in b["ids"].to_pylist() for i in x] == library.encode(text)
        assert [i for b in got for i in b["part"].to_pylist()] == list(range(len(parts)))
        tracemalloc.start()
        assert max(out.num_rows for out in piece_scan.traced(pieces, batch, 8)) == 8
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    # of 240 chunks more, the ids alone would be 0.6 MB as numbers and over 4 MB as lists
    assert peaks[1] < peaks[0] + (1 << 18)
