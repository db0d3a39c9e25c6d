"""The features of the quality classifier need little memory beside a chunk of texts."""
import tracemalloc

import pyarrow as pa

from tallyspark.llm import common, quality


def test_running_sums_count_hits_before_each_byte():
    assert quality._running(quality._UPPER[[65, 97, 66]]).tolist() == [0, 1, 1, 2]
    assert quality._running(quality._UPPER[[]]).tolist() == [0]


def test_features_of_a_chunk_of_long_words_stay_within_some_bytes_per_byte():
    text = pa.array([" ".join(["x" * 400] * (common.CHUNK_BYTES // 401))])
    tracemalloc.start()
    n = sum(len(b) for b, _, _ in quality.features(text))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 2 * (common.CHUNK_BYTES // 401) + 2
    assert peak < 22 * common.CHUNK_BYTES
