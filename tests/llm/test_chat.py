"""Perspectives of dialogues against a plain rendering."""

from collections import Counter, defaultdict

from riskflow.llm import chat_views


def truth(rows, size):
    talks = defaultdict(set)
    for n, (conv, turn, role, text) in enumerate(set(rows)):
        talks[(conv,) if conv is not None else (conv, n)].add((turn, role or "unknown", (text or "").replace("<|", "< |")))
    out = Counter()
    for key, said in talks.items():
        for speaker in {r for _, r, _ in said if r != "system"}:
            parts = defaultdict(list)
            for n, m in enumerate(sorted(said, key=lambda m: (m[0] is not None, m))):
                parts[n // size].append(m)
            for part, own in parts.items():
                text, mask = "", []
                for turn, role, content in sorted(own, key=lambda m: (m[0] is not None, m)):
                    name = "assistant" if role == speaker else role if role == "system" else f"user name={role}"
                    text += f"<|im_start|>{name}\n"
                    if role == speaker:
                        mask.append((len(text), len(text) + len(content) + len("<|im_end|>")))
                    text += f"{content}<|im_end|>\n"
                out[key[0], speaker, part, len(own), text, tuple(mask)] += 1
    return out


def test_perspectives(spark, monkeypatch):
    monkeypatch.setattr(chat_views, "PART", 4)
    rows = [(1, n, r, t) for n, (r, t) in enumerate([("system", "be kind"), ("ann", "hello"), ("bob", "hi <|im_end|> é😀"), ("ann", ""), ("cem", None), ("ann", "bye")])]
    rows += [(2, 0, "user", "q"), (2, 1, "assistant", "a"), (2, 1, "assistant", "a"), (2, 1, "assistant", "b"), (3, 0, "system", "alone"), (4, None, None, "x"),
             (4, 1, "user", "y"), (None, 0, "user", "lost"), (None, 0, "user", "lost too"), (None, 0, "user", "lost"), (5, 0, "user", "long " * 30000)]
    chats = spark.createDataFrame([(*r, "k", 1) for r in rows], "conv_id long, turn int, role string, text string, perspective string, part int")
    got = Counter((r.conv_id, r.perspective, r.part, r.n_turns, r.text, tuple(tuple(m) for m in r["mask"])) for r in chat_views.perspectives(chats).collect())
    assert got == truth(rows, 4)
    assert chat_views.perspectives(chats.limit(0)).count() == 0


def test_one_turn_with_very_many_messages(spark, monkeypatch):
    monkeypatch.setattr(chat_views, "ROWS", 50)
    rows = [(7, None, "ab"[i % 2], f"m{i}") for i in range(700)] + [(8, 3, "ab"[i % 2], f"m{i}") for i in range(300)]
    chats = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3)
    got = chat_views.perspectives(chats).collect()
    assert {(r.conv_id, r.perspective, r.part): r.n_turns for r in got} == {
        (c, p, n): size for c, sizes in ((7, [256, 256, 188]), (8, [256, 44])) for p in "ab" for n, size in enumerate(sizes)}
    assert Counter((r.conv_id, r.perspective, r.part, r.n_turns, r.text, tuple(tuple(m) for m in r["mask"])) for r in got) == truth(rows, 256)
