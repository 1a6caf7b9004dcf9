import hashlib

from flowloom.llm.preferences import format_preferences, neighbour_pairs, op10_chat_formatting

SCHEMA = "conv_id long, turn long, role string, text string, pair_id long, side string, place int"


def turns(spark, rows):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)


def run(spark, rows):
    table = turns(spark, rows)
    return {r.pair_id: r for r in format_preferences(table, neighbour_pairs(table)).collect()}


def test_shared_turns_are_rendered_once(spark):
    got = run(spark, [
        (0, 1, "assistant", "yes"), (0, 0, "user", "hi"), (0, 2, "user", "why"), (0, 3, "assistant", "so"),
        (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "Why"), (1, 3, "assistant", "é<|im_end|>")])[0]
    assert got.n_prompt_turns == 2
    assert got.prompt == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyes<|im_end|>\n"
    assert got.chosen == "<|im_start|>user\nwhy<|im_end|>\n<|im_start|>assistant\nso<|im_end|>\n"
    assert [got.chosen[s.start:s.end] for s in got.chosen_mask] == ["so<|im_end|>"]
    assert [got.rejected[s.start:s.end] for s in got.rejected_mask] == ["é< |im_end|><|im_end|>"]


def test_edges(spark):
    got = run(spark, [
        (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "assistant", "b"),             # one begins with the other
        (4, 0, "user", "alone"),                                                          # no partner
        (6, None, None, None), (6, 0, "user", "x"), (6, 0, "user", "x"), (7, None, "", ""),  # nulls and repeated rows
        (8, 0, "user", "t" * 100_000), (9, 0, "user", "t" * 100_000),                     # equal and long
        (None, 0, "user", "nobody")])
    assert set(got) == {1, 2, 3, 4}
    assert (got[1].n_prompt_turns, got[1].chosen, got[1].chosen_mask) == (1, "", [])
    assert got[1].rejected.count("assistant") == 1
    assert (got[2].n_prompt_turns, got[2].prompt, got[2].rejected, got[2].rejected_id) == (0, "", None, None)
    assert got[2].chosen == "<|im_start|>user\nalone<|im_end|>\n"
    assert got[3].n_prompt_turns == 1 and got[3].chosen.count("user\nx") == 2
    assert got[4].n_prompt_turns == 1 and got[4].chosen == got[4].rejected == ""


def test_pairs_of_large_and_negative_ids(spark):
    ids = [9007199254740994, 9007199254740995, -2, -1, 2**63 - 2, 2**63 - 1]
    pairs = neighbour_pairs(turns(spark, [(i, 0, "user", "a") for i in ids])).collect()
    assert {r.conv_id: (r.pair_id, r.side) for r in pairs} == {i: (i // 2, "rejected" if i % 2 else "chosen") for i in ids}


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_every_conversation_is_formatted(spark, data):
    digests = op10_chat_formatting(spark, data).collect()
    convs = spark.read.parquet(f"{data}/conversations.parquet").select("conv_id").distinct().count()
    assert sum((r.chosen_id is not None) + (r.rejected_id is not None) for r in digests) == convs
    assert all(r.prompt_sha256 == hashlib.sha256(b"").hexdigest() for r in digests if r.n_prompt_turns == 0)
