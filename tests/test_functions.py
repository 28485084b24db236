import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fundlens.functions import text, times, values



def apply(rows, column, data, schema="x STRING"):
    frame = rows([(d,) for d in data], schema)
    return [r[0] for r in frame.select(column(F.col("x"))).collect()]


def test_normalize_title_keeps_unicode_words(rows):
    got = apply(rows, lambda C: text.normalize_title(C), ["  Café!  Déjà-vu_2 ", "\t...", "ÄÖ　x²", None])
    assert got == ["café déjàvu_2", "", "äö x²", None]


def test_repo_owner(rows):
    urls = ["https://github.com/Ab/c", "http://github.com/AB", "ab/c", "Solo", "https://www.github.com/x", None]
    assert apply(rows, lambda C: text.repo_owner(C), urls) == ["ab", "ab", "ab", "solo", "https:", None]


def test_repair_hex_prefix(rows):
    assert apply(rows, lambda C: text.repair_hex_prefix(C), ["OXAB", "0xCd", "", None]) == ["0xab", "0xcd", "0", "0"]


def test_json_text(rows):
    docs = ['{"a":{"b":"v"}}', '{"a":{"b":null}}', '{"a":{}}', '{"a":{"b":{"c":1}}}', None]
    assert apply(rows, lambda C: text.json_text(C, "a", "b"), docs) == ["v", None, None, '{"c":1}', None]


def test_concat_null_rules(rows):
    assert apply(rows, lambda C: text.concat_text(F.lit("a"), C), ["b", None]) == ["ab", None]
    assert apply(rows, lambda C: text.concat_skip_null(F.lit("a"), C), ["b", None]) == ["ab", "a"]


def test_row_hash_is_null_if_a_part_is(rows):
    assert apply(rows, lambda C: text.row_hash(F.lit("a"), C), ["bc", None]) == [hashlib.sha256(b"abc").hexdigest(), None]


def test_valid_address(rows):
    data = ["0x" + "aF" * 20, "0x" + "a" * 39, "0X" + "a" * 40, None]
    assert apply(rows, lambda C: text.valid_address(C), data) == [True, False, False, None]


def test_epoch_ms_cuts_the_milliseconds(rows):
    assert apply(rows, lambda C: times.epoch_ms_ts(C), ["1700000000999", None]) == [datetime(2023, 11, 14, 22, 13, 20), None]


def test_timestamps_lenient_and_strict(rows):
    data = ["2024-01-02 03:04:05", "1/2/2024", "bad", None]
    day = datetime(2024, 1, 2)
    assert apply(rows, lambda C: times.lenient_ts(C, "M/d/yyyy"), data) == [datetime(2024, 1, 2, 3, 4, 5), day, None, None]
    with pytest.raises(Exception, match="not a timestamp"):
        apply(rows, lambda C: times.strict_ts(C), data)


def test_version_of_two_or_three_digits(rows):
    data = ["chain_data_86", "chain_data_100", "chain_data_1", "chain_data_1000", "other", None]
    assert apply(rows, lambda C: times.version_of(C), data) == [86, 100, None, None, None, None]


def test_money(rows):
    assert apply(rows, lambda C: values.money(C), ["$1,234.50", "7", None]) == [1234.5, 7.0, None]
    assert apply(rows, lambda C: values.money(C, strict=False), ["x"]) == [None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply(rows, lambda C: values.money(C), ["x"])


def test_safe_div_by_zero(rows):
    assert apply(rows, lambda C: values.safe_div(F.lit(3), C), [2, 0, None], "x INT") == [1.5, None, None]


def test_match_usd_rescales_one_round(rows):
    rid = "0xa1d52f9b5339792651861329a046dd912761e9a9"
    got = apply(rows, lambda C: values.match_usd(F.lit("250000000000"), F.lit(100), C), [rid])
    assert got == [25.0]


def test_labels(rows):
    names = ["", "allov1.QF", "allov2.DirectAllocationStrategy", "other", None]
    assert apply(rows, lambda C: values.strategy_title(C), names) == ["", "Allo QF", "Direct Donations", "other", None]
    assert apply(rows, lambda C: values.strategy_or_default(C), ["", None, "a"]) == ["allov1.QF", None, "a"]
    assert apply(rows, lambda C: values.chain_of_checkout(C), ["eth_std", "eth_polygon", "eth_zksync", "x", None]) == [
        1, 137, 324, 0, 0,
    ]
