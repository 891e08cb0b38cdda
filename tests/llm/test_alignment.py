"""Token alignment against a plain version over the libraries' tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from dealspark.llm import alignment, common
from dealspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(common.vocabulary(alignment.SIDE_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=common.vocabulary("piece_bpe_32k.model"))


def spans(lengths):
    out, at = [], 0
    for n in lengths:
        out.append((at, at + n))
        at += n
    return out


def plain(tools, texts):
    """The contract's columns, and the count of every pair."""
    a_tool, b_tool = tools
    letter = {c: b for b, c in alignment._byte_letters().items()}
    docs = []
    for text in texts:
        a_ids = a_tool.encode(" " + text, add_special_tokens=False).ids if text else []
        b_ids = b_tool.encode(text) if text else []
        a_raw = [bytes(letter[c] for c in a_tool.id_to_token(i)) for i in a_ids]
        b_raw = [bytes([int(p[3:5], 16)]) if b_tool.is_byte(i) else p.replace("▁", " ").encode()
                 for i, p in zip(b_ids, map(b_tool.id_to_piece, b_ids))]
        if not text or b"".join(a_raw) != (" " + text).encode() or b"".join(b_raw) != (" " + text).encode():
            docs.append(([], [], [], []))
            continue
        a_at, b_at = spans(map(len, a_raw)), spans(map(len, b_raw))
        links, k = [], 0
        for i, (s, e) in enumerate(a_at):
            while b_at[k][1] <= s:
                k += 1
            j = k
            while j < len(b_at) and b_at[j][0] < e:
                links.append((a_ids[i], b_ids[j]))
                j += 1
        both = sorted({e for _, e in a_at} & {e for _, e in b_at})
        groups, i, j = [], 0, 0
        for cut in both:
            own = [], []
            while i < len(a_at) and a_at[i][1] <= cut:
                own[0].append(a_ids[i])
                i += 1
            while j < len(b_at) and b_at[j][1] <= cut:
                own[1].append(b_ids[j])
                j += 1
            groups.append("|".join(",".join(map(str, x)) for x in own))
        docs.append((a_ids, b_ids, groups, links))
    count = Counter(p for *_, links in docs for p in set(links))
    highest = defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    rows = []
    for a_ids, b_ids, groups, links in docs:
        rows.append((len(a_ids), len(b_ids), len(groups), len(links), sum(count[p] == highest[p[0]] for p in links),
                     sum(count[p] for p in links), ";".join(groups)))
    return rows, count, highest


def digest(row):
    return (*row[:-1], hashlib.sha256(row[-1].encode()).hexdigest() if row[-1] else "")


def test_query(spark, tools):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows, _, _ = plain(tools, [t or "" for _, t in docs])
    got = QUERIES["op13_token_alignment"](spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter((i, *digest(r)) for (i, _), r in zip(docs, rows))


def test_odd_texts_groups_and_counts(spark, tools, monkeypatch):
    monkeypatch.setattr(alignment, "FAN", 3)  # several rounds of merging
    rng = random.Random(5)
    texts = ["", " ", "a▁b", "<|endoftext|> </s>", "x );\r\n  y", "\t\r \n é🙂東京\x00", "l'été  d’or\n\n", " " * 40, "a" * 3000, "1234567 89"]
    for letters in ("ab \n", "東京 d", "é🙂 x\r;", "etaoin shrdlu\n", "\t \n\r(){};a"):
        texts += ["".join(rng.choice(letters) for _ in range(rng.choice([2, 20, 200]))) for _ in range(40)]
    texts += [texts[30]] * 50
    rows, count, highest = plain(tools, texts)
    data = [(i if i % 7 else None, t or (None if i % 2 else "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("block", alignment.F.lit("x")).repartition(20)
    got = alignment.align(df, with_groups=True).collect()
    assert Counter(map(tuple, got)) == Counter((i, *r) for (i, _), r in zip(data, rows))
    found = {(r["a"], r["b"]): (r["documents"], r["best"]) for r in alignment.pair_counts(df).collect()}
    assert found == {p: (n, n == highest[p[0]]) for p, n in count.items()}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(df).collect() == []
    nothing = spark.createDataFrame([(1, None), (1, ""), (None, None)], "doc_id long, text string")
    assert Counter(map(tuple, alignment.align(nothing).collect())) == Counter(
        [(1, 0, 0, 0, 0, 0, 0, "")] * 2 + [(None, 0, 0, 0, 0, 0, 0, "")])
