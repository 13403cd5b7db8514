import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarrylake.llm import language_id, quality, toxicity
from quarrylake.llm.queries import QUERIES

from .conftest import ODD


def held_out(i, n, k):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n == k


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = language_id.Network(["a", "b"], language_id.Gru.new(3, rng), language_id.Gru.new(3, rng), rng.normal(0, 0.3, (6, 2)), np.zeros(2))
    for gru in (net.ahead, net.behind):
        gru.inputs, gru.recurrent = gru.inputs.astype("f8"), gru.recurrent.astype("f8")
    text, label = rng.integers(0, 5, (4, 3)).astype(np.uint8), np.array([0, 1, 1])

    def loss():
        both = np.concatenate([net.ahead.run(text), net.behind.run(text[::-1])[::-1]], axis=2).astype("f8")
        return -np.log(language_id._softmax(both @ net.out + net.bias)[:, np.arange(3), label]).mean()

    for w, g in zip(net.weights(), net.gradients(text, label)):
        at = (int(text[1, 1]), 1) if w.shape[0] == 256 else (0,) * w.ndim
        step = 2e-2
        w[at] += step
        up = loss()
        w[at] -= 2 * step
        down = loss()
        w[at] += step
        assert (up - down) / (2 * step) == pytest.approx(g[at], rel=0.02, abs=2e-6)


def test_segments_and_batches_change_nothing(monkeypatch):
    rng = np.random.default_rng(1)
    net = language_id.train([b"hello there " * 20, "ça va très bien ".encode() * 20], ["en", "fr"], steps=5)
    texts = pa.array(["".join(map(chr, rng.integers(97, 123, n))) for n in (0, 1, 5, 256, 257, 700)])
    p, runs = language_id.label_texts(net, texts, spans=True)
    monkeypatch.setattr(language_id, "SIDE_BY_SIDE", 2)
    assert np.allclose(p, language_id.label_texts(net, texts)[0], atol=1e-5)
    for text, own in zip(texts.to_pylist(), runs):
        assert [a for a, _, _ in own] == [0, *[b for _, b, _ in own[:-1]]][: len(own)] and (not own or own[-1][1] == len(text))


def test_segments_label_much_as_one_run_over_the_whole_text(monkeypatch):
    net = language_id.train([b"the hello there and this " * 20, "ça va très bien où été ".encode() * 20], ["en", "fr"], steps=60)
    rng = np.random.default_rng(8)
    words = ["the hello there and this".split(), "ça va très bien où été".split()]
    texts = pa.array([" ".join(words[i // 40 % 2][k % 5] for i, k in enumerate(rng.integers(0, 5, n))) for n in (1, 60, 150, 900)])
    spread = lambda found: np.array([x for own in found for a, b, x in own for _ in range(a, b)])
    labels = {}
    for name, segment, warm in (("used", language_id.SEGMENT, language_id.WARM), ("cold", language_id.SEGMENT, 0), ("whole", 1 << 20, 0)):
        monkeypatch.setattr(language_id, "SEGMENT", segment)
        monkeypatch.setattr(language_id, "WARM", warm)
        labels[name] = spread(language_id.label_texts(net, texts, spans=True)[1])
    assert (labels["used"] == labels["whole"]).mean() >= max(0.97, (labels["cold"] == labels["whole"]).mean())


def test_states_are_those_of_a_plain_loop():
    """The forward pass against the equations of a gated recurrent unit, one byte at a time."""
    rng = np.random.default_rng(2)
    gru, text = language_id.Gru.new(4, rng), rng.integers(0, 256, (9, 3)).astype(np.uint8)
    states, logistic = gru.run(text), lambda x: 1 / (1 + np.exp(-x))
    for lane in range(3):
        h = np.zeros(4)
        for t in range(9):
            given, back = gru.inputs[text[t, lane]].astype("f8"), h @ gru.recurrent.astype("f8")
            r, z = logistic(given[:4] + back[:4]), logistic(given[4:8] + back[4:8])
            h = z * h + (1 - z) * np.tanh(given[8:] + r * back[8:])
            assert np.allclose(states[t, lane], h, atol=1e-4)


def test_parts_come_from_whole_texts_in_any_number_of_languages(spark):
    rows = [(i, f"x{i % 300}", f"{i % 300:03d}" * 400 + "end") for i in range(900)] + [(1000, "long", "a" * 50_000 + "z" * 50_000), (1001, "long", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    drawn = language_id.sample(docs)
    assert len({x for x, _ in drawn}) == 301 and {"a", "z"} <= {c for x, t in drawn if x == "long" for c in t}
    assert all(len(t) <= language_id.PART_CHARS for _, t in drawn)


def test_language_id(spark, small, odd, empty):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = QUERIES["op2_language_id"](spark, small).collect()
    right = [r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out]
    assert len(got) == len(docs) and np.mean(right) > 0.9 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == held_out(r.doc_id, 4, 2) for r in got)
    rows = QUERIES["op2_language_id"](spark, odd).collect()
    assert len(rows) == len(ODD) and {r.lang_pred for r in rows if r.doc_id in (3, 4, 5, 13)} == {"und"}
    assert QUERIES["op2_language_id"](spark, empty).count() == 0


TOXIC, CLEAN = ["idiot", "moron", "scumbag", "loser"], ["the", "cat", "sat", "on", "mats", "today", "with", "some", "friends", "again"]


def made(n, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = list(rng.choice(CLEAN, 12)) + [f"n{x}" for x in "".join(map(str, rng.integers(0, 9, 4)))]
        toxic = int(i % 4 == 0)
        if toxic:
            words[int(rng.integers(12))] = str(rng.choice(TOXIC))
        rows.append((" ".join(words), toxic))
    return rows


def learnt(spark, texts, labels):
    """A scorer, its model counted over the same texts."""
    model = toxicity.CharModel.of(toxicity.frequencies_of((w, 1) for t in texts for w in set(t.split())))
    return toxicity.learn(spark.createDataFrame(list(zip(range(len(texts)), texts, labels)), "id bigint, text string, label int"), model)


@pytest.fixture(scope="module")
def scorer(spark):
    rows = made(600)
    return learnt(spark, [t for t, _ in rows], [x for _, x in rows])


@pytest.mark.parametrize(
    "text, bad",
    [("you 1d10t", 1), ("m0r0n", 1), ("an i d i o t here", 1), ("l-o-s-e-r", 1), ("a looooser", 1), ("m*ron", 1), ("IDIOT!!", 1), ("$cumbag", 1),
     ("the cat sat", 0), ("", 0), ("3 cats, 4 mats", 0), ("a b c", 0), ("don't sit-on mats", 0)],
)
def test_disguises(scorer, text, bad):
    assert int(scorer.score(pa.array([text]))[0] >= 0.5) == bad


def test_words_without_disguise_are_their_own_restoration(scorer):
    for word in (*CLEAN, *TOXIC, "élan", "unseen"):
        assert toxicity.restored_core(word, scorer.model) == word


def test_toxicity(spark, table, odd, empty):
    rows = made(400, 1)
    folder = table([(i, t) for i, (t, _) in enumerate(rows)] + ODD, [(i, 1, x) for i, (_, x) in enumerate(rows)] + [(None, 1, 1), (5, None, None)])
    got = QUERIES["op10_toxicity"](spark, folder).collect()
    assert len(got) == len(rows) + len(ODD) and all(r.held_out == held_out(r.doc_id, 5, 0) and r.predicted == int(r.score >= 0.5) for r in got)
    right = [r.predicted == rows[r.doc_id][1] for r in got if r.doc_id is not None and r.doc_id > 20 and r.held_out]
    assert np.mean(right) > 0.95
    assert QUERIES["op10_toxicity"](spark, odd).count() == len(ODD) and QUERIES["op10_toxicity"](spark, empty).count() == 0


def test_weak_labels_find_who_is_right():
    rng = np.random.default_rng(3)
    n = len(quality.LABELLERS)
    good = rng.random(4000) < 0.85
    kind = rng.integers(0, n - 2, 4000)
    vote = np.full((4000, n), quality.ABSTAIN)
    for k in range(n - 2):  # each fault has its own labeller, which is right nine times of ten
        bad = ~good & (kind == k)
        vote[bad & (rng.random(4000) < 0.9), k] = quality.BAD
    for k in (n - 2, n - 1):
        vote[good & (rng.random(4000) < 0.8), k] = quality.GOOD
    code = (vote * 3 ** np.arange(n - 1, -1, -1)).sum(axis=1)
    patterns, where, counts = np.unique(code, return_inverse=True, return_counts=True)
    posterior, table, share = quality.weak_labels(patterns, counts.astype(float))
    assert ((posterior[where] >= 0.5) == good).mean() > 0.95 and 0.75 < share < 0.95


def votes(n, seed, wrong):
    """Simulated votes; labeller 0 also votes bad on a share ``wrong`` of good texts."""
    rng = np.random.default_rng(seed)
    kinds = quality.FAULTS
    good, kind = rng.random(n) < 0.8, rng.integers(0, kinds, n)
    vote = np.full((n, kinds + 2), quality.ABSTAIN)
    for k in range(kinds):
        vote[~good & (kind == k) & (rng.random(n) < 0.9), k] = quality.BAD
    vote[good & (rng.random(n) < wrong), 0] = quality.BAD
    for k in (kinds, kinds + 1):
        u = rng.random(n)
        vote[:, k] = np.where(good, np.where(u < 0.85, quality.GOOD, quality.ABSTAIN), np.where(u < 0.5, quality.BAD, np.where(u < 0.6, quality.GOOD, quality.ABSTAIN)))
    return good, (vote * 3 ** np.arange(kinds + 1, -1, -1)).sum(axis=1)


@pytest.mark.parametrize("wrong", [0.0, 0.05])
def test_a_labellers_precision_is_estimated(wrong):
    good, code = votes(20_000, 4, wrong)
    patterns, where, counts = np.unique(code, return_inverse=True, return_counts=True)
    posterior, table, share = quality.weak_labels(patterns, counts.astype(float))
    got = next(iter(quality.precisions(patterns, counts, posterior).values()))
    own = quality.digits(code)[:, 0] == quality.BAD
    assert got == pytest.approx((~good)[own].mean(), abs=0.1)
    assert ((posterior[where] >= 0.5) == good).mean() > 0.95 and share == pytest.approx(good.mean(), abs=0.05)
    # Each pattern's posterior is Bayes' rule under the part tables, and estimated rates are near the true ones.
    assert table[1, 0, quality.BAD] == pytest.approx(own[good].mean(), abs=0.03)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3 ** len(quality.LABELLERS) - 1), st.integers(1, 5000)), min_size=1, max_size=25, unique_by=lambda x: x[0]))
def test_no_round_lowers_the_objective(patterns):
    """Likelihood times priors, reckoned by ``weak_labels`` before each round; the posterior is Bayes' rule."""
    course = []
    code, counts = np.array([p for p, _ in patterns]), np.array([n for _, n in patterns], float)
    posterior, table, share = quality.weak_labels(code, counts, rounds=60, course=course)
    assert len(course) > 1 and all(b >= a - 1e-6 * max(1, abs(a)) for a, b in zip(course, course[1:]))
    assert np.all((posterior >= 0) & (posterior <= 1 + 1e-9)) and 0 < share < 1 and np.isfinite(table).all()


def test_silence_keeps_the_prior():
    silent = sum(3**k for k in range(len(quality.LABELLERS)))
    good, code = votes(5000, 6, 0.0)
    patterns, counts = np.unique(np.r_[code, np.full(500, silent)], return_counts=True)
    posterior, _, share = quality.weak_labels(patterns, counts.astype(float))
    assert posterior[patterns == silent][0] >= share - 0.05


#: Plain prose in a dozen scripts.
PROSE = {
    "Latin": "The river rose quickly after the storm, and the village prepared for a long night. People moved their tools to the higher ground.",
    "Japanese": "昨日は朝から雨が降っていたので、家で本を読んで過ごした。午後になると空が晴れて、近くの公園まで散歩に出かけた。子どもたちが楽しそうに遊んでいた。",
    "Chinese": "昨天下午我们去了城外的一座小山，天气很好，路上的人也不多。山顶有一座古老的寺庙，里面很安静。我们在那里休息了一会儿，然后慢慢走下山。",
    "Korean": "어제는 아침부터 비가 와서 집에서 책을 읽으며 시간을 보냈다. 오후에 하늘이 맑아져서 가까운 공원으로 산책을 나갔다.",
    "Hindi": "कल सुबह से बारिश हो रही थी, इसलिए हम घर पर ही रहे और किताबें पढ़ीं। दोपहर में आसमान साफ हो गया और हम पास के बगीचे में टहलने गए।",
    "Thai": "เมื่อวานนี้ฝนตกตั้งแต่เช้า เราจึงอยู่บ้านอ่านหนังสือกันทั้งวัน ตอนบ่ายท้องฟ้าแจ่มใสขึ้น เราเลยออกไปเดินเล่นที่สวนสาธารณะใกล้บ้าน",
    "Arabic": "كان الجو ممطرا منذ الصباح، لذلك بقينا في البيت وقرأنا الكتب. هل كان الأطفال يلعبون بسعادة؟ نعم، كانوا سعداء جدا.",
    "Cyrillic": "Вчера с утра шёл дождь, поэтому мы остались дома и читали книги. Днём небо прояснилось, и мы пошли гулять в соседний парк.",
    "Greek": "Χθες έβρεχε από το πρωί, οπότε μείναμε στο σπίτι και διαβάσαμε βιβλία. Το απόγευμα ο ουρανός καθάρισε και βγήκαμε για περπάτημα.",
    "Hebrew": "אתמול ירד גשם מהבוקר, ולכן נשארנו בבית וקראנו ספרים. אחר הצהריים השמיים התבהרו ויצאנו לטיול בפארק הסמוך.",
    "Ethiopic": "ትናንት ከጠዋት ጀምሮ ዝናብ ነበር፣ ስለዚህ ቤት ውስጥ ቆየን እና መጽሐፍት አነበብን። ከሰዓት በኋላ ሰማዩ ጠራ እና በአቅራቢያው ወዳለው መናፈሻ ሄድን።",
    "Tamil": "நேற்று காலை முதல் மழை பெய்தது, அதனால் நாங்கள் வீட்டில் தங்கி புத்தகங்கள் படித்தோம். மாலையில் வானம் தெளிவானது, நாங்கள் பூங்காவிற்கு சென்றோம்.",
}


def faults_of(text):
    own = quality.words(quality.spaced(pa.array([text])))[0].to_pylist()
    return [" ".join("#$" + w + "&*" for w in own), " ".join(w + "!!!" for w in own), " | ".join(own), " ".join(own[:1] * 60)]


def test_prose_of_any_script_is_kept_and_its_faults_are_not(spark, table, odd):
    """In the pipeline's stage, with all other documents in English and German."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    plain = [(10_000 + i, t, "x", "s") for i, t in enumerate(PROSE.values())] + [(10_500 + i, t * 40, "x", "s") for i, t in enumerate(PROSE.values())]
    bad = [(20_000 + 10 * i + k, t, "x", "s") for i, p in enumerate(PROSE.values()) for k, t in enumerate(faults_of(p))]
    own = spark.createDataFrame(plain + bad, docs.schema)
    kept = {r.doc_id for r in quality.keep_good(spark, docs.unionByName(own), "").select("doc_id").collect()}
    assert [i for i, *_ in plain if i not in kept] == [] and [i for i, *_ in bad if i in kept] == []
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert [i for i, q in labels.items() if q == 1 and i not in kept] == [] and sum(i in kept for i, q in labels.items() if q == 0) <= 1


@pytest.mark.parametrize("words", [398, 404, 20_000])
def test_few_distinct_words_are_seen_at_any_length(words):
    facts = quality.Facts(pa.array([" ".join(["spam egg"] * (words // 2)), " ".join(f"w{i * 7919 % 5003}" for i in range(words))]))
    assert quality.digits(quality.votes_of(facts))[:, 5].tolist() == [quality.BAD, quality.ABSTAIN]


def test_shapes():
    got = quality.shapes_of(pa.array(["Hello,", "THIS!!", "ÉTÉ", "straße", "a1b22", "Ωmega", "", "--->"]))
    assert got.to_pylist() == ["Aa,", "A!", "A", "a", "a0a0", "Aa", "", "->"]


def test_quality(spark, odd, empty):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op9_quality"](spark, folder).collect()}
    kept_good = np.mean([got[i].kept for i, q in labels.items() if q == 1])
    dropped_bad = np.mean([not got[i].kept for i, q in labels.items() if q == 0])
    assert kept_good > 0.98 and dropped_bad > 0.9
    rows = QUERIES["op9_quality"](spark, odd).collect()
    assert len(rows) == len(ODD) and all(not r.kept and r.score == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert QUERIES["op9_quality"](spark, empty).count() == 0


def test_corpus_statistics_read_all_documents(spark, table):
    rows = made(60)
    texts = [t for t, _ in rows] + ["dunderhead " * 3] * 2  # a word that no labelled text holds
    docs = spark.read.parquet(f"{table(list(enumerate(texts)))}/documents.parquet")
    model = toxicity.corpus_model(docs)
    own = toxicity.CharModel.of(toxicity.frequencies_of((w, 1) for t in texts for w in t.split()))
    assert "dunderhead" in model.lexicon and toxicity.restored_core("dund3rh34d", model) == "dunderhead"
    assert len(model.lexicon.hashes) == len(own.lexicon) and len(model.counts.hashes) == len(own.counts)
    assert all(model.lexicon.get(w) == pytest.approx(x, rel=1e-5) for w, x in own.lexicon.items())
    assert all(model.counts.get(g) == n for g, n in own.counts.items())


@pytest.mark.parametrize(
    "text", ["id" + "i" * 60 + "ot", "-".join("moron") + "-" * 40, ".".join(["the", "cat"] * 6 + ["x"]) + " scum" + "-" * 50 + "bag",
             " ".join("the" * 20 + "idiot"), " ".join("catidiot"), "i " + "d " * 20 + "i o t", " ".join("todayloser" * 9)],
)
def test_disguises_of_any_length(scorer, text):
    assert scorer.score(pa.array([text]))[0] >= 0.5


def cheapest(word, model):
    """The least cost of any path through the lattice, by trying all of them."""
    inside, best = toxicity.inner(word), float("inf")
    number = not any(map(str.isalpha, word))
    for path in itertools.product(*(toxicity.readings(word, i, inside) for i in range(len(word)))):
        if number and any(not letter and c.isdigit() for c, (letter, _) in zip(word, path)):
            continue
        out = "".join(letter for letter, _ in path)
        padded = toxicity.BEGIN + out + "$"
        cost = sum(p for _, p in path) + sum(model.cost(padded[i - 3 : i], padded[i]) for i in range(3, len(padded)))
        best = min(best, cost)
    return best, inside


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aais1!$.*t5", min_size=1, max_size=7))
def test_decoding_finds_the_cheapest_of_all_paths(word):
    model = toxicity.CharModel.of(toxicity.Counter({"stasis": 9, "assist": 7, "tail": 5, "sit": 4}))
    model.lexicon = {}
    out = toxicity.restore(word, model)
    found = []
    inside = toxicity.inner(word)
    for path in itertools.product(*(toxicity.readings(word, i, inside) for i in range(len(word)))):
        if "".join(letter for letter, _ in path) == out:
            padded = toxicity.BEGIN + out + "$"
            found.append(sum(p for _, p in path) + sum(model.cost(padded[i - 3 : i], padded[i]) for i in range(3, len(padded))))
    assert min(found) == pytest.approx(cheapest(word, model)[0])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="abß😀", min_size=1, max_size=6), st.integers(1, 9)), max_size=8, unique_by=lambda x: x[0]))
def test_grams_are_counted_by_arrays_as_one_by_one(words):
    names, n = toxicity.gram_counts([w for w, _ in words], np.array([c for _, c in words], np.int64)) if words else ([], np.empty(0, np.int64))
    got, want = toxicity.Counter(), toxicity.Counter()
    for name, c in zip(names, n.tolist()):
        got[name] += c
    for w, c in words:
        for gram in toxicity.grams_of(w):
            want[gram] += c
    assert got == want


def test_short_words_inside_a_run():
    model = toxicity.CharModel.of(toxicity.Counter({"fag": 40, "you": 400, "are": 300, "cat": 300, "idiot": 50}))
    assert toxicity.restore_run(" ".join("youarefag"), model) == ["you", "are", "fag"]
    assert toxicity.restore_run(" ".join("fag" + "you" * 15), model) == ["fag"] + ["you"] * 15


@pytest.mark.parametrize(
    "text, bad",
    [("a$$", 1), ("@$$", 1), ("dumba$$", 1), ("$h1t", 1), ("$hit!", 1), ("stuupid", 1), ("455", 1), ("i. d. i. o. t.", 1), ("id io t", 1), ("(i) - [d] - i o t", 1),
     ("!diot", 1), ("*diot*", 1), ("hat!", 0), ("(the cat)", 0), ("$100 4 cats", 0), ("a hit, it is so", 0), ("too good", 0), ("it is as it is", 0), ("| a | b |", 0), ("454 457", 0)],
)
def test_signs_at_edges_double_letters_and_pieces(signs, text, bad):
    assert int(signs.score(pa.array([text]))[0] >= 0.5) == bad


@pytest.fixture(scope="module")
def signs(spark):
    toxic = ["ass", "shit", "stupid", "idiot", "dumbass"]
    clean = ["a", "hat", "hit", "too", "to", "good", "it", "is", "as", "so", "457", "454", *CLEAN]
    rng = np.random.default_rng(5)
    rows = [" ".join([*rng.choice(clean, 12), *([str(rng.choice(toxic))] if i % 4 == 0 else [])]) for i in range(600)]
    return learnt(spark, rows, [int(i % 4 == 0) for i in range(600)])
