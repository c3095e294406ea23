import math

from cases import clashing, documents, empty, rows_of

from clicksieve.llm import language_id
from clicksieve.llm.common import table


def test_every_byte_run_lies_in_a_window():
    for size in (0, 1, 255, 256, 257, 508, 509, 510, 5000):
        text = "".join(chr(97 + i % 26) for i in range(size))
        every = language_id.windows_of(text)
        assert every.shape[1] == language_id.WINDOW
        runs = {text[i : i + 4] for i in range(size - 3)}
        assert runs <= {bytes(w[i : i + 4]).decode() for w in every for i in range(len(w) - 3)}


def test_held_out_accuracy(spark, data):
    docs = table(spark, data("0.01"), "documents")
    found = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.97 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_awkward_rows(spark):
    network = language_id.train(documents(spark))
    found = language_id.identify(documents(spark), network)
    assert found.count() == documents(spark).count()
    assert rows_of(found) == rows_of(language_id.identify(clashing(spark), network))
    und = {r["doc_id"] for r in found.where("lang_pred = 'und'").collect()}
    assert {0, 1, 2, 11, 12} <= und and 5 not in und
    kept = language_id.filter_language(clashing(spark), network, least=0.0)
    assert kept.columns == clashing(spark).columns
    assert kept.count() == found.where("lang_pred <> 'und'").count()


def test_nothing_is_learned_from_nothing(spark):
    assert language_id.identify(empty(spark)).count() == 0
    unlabelled = documents(spark, [(1, "some text", None, None, 9), (2, None, "en", None, 0)])
    assert {r["lang_pred"] for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_training_does_not_see_what_is_held_out(spark):
    rows = [(i, f"text number {i}", "en" if i % 2 else "fr", None, 1) for i in range(200)]
    held = documents(spark, rows).where(language_id.held_out())
    seen = documents(spark, rows).where(~language_id.held_out())
    windows, _, _ = language_id.sample_windows(seen)
    texts = {bytes(w).decode().strip() for w in windows}
    assert not texts & {r["text"] for r in held.collect()}


def plain_prediction(network, text):
    """Byte by byte and filter by filter: each window's greatest responses, the softmax, and the mean over windows."""
    data = list(text.encode())
    count = max(1, math.ceil((len(data) - language_id.WINDOW) / language_id.STRIDE) + 1)
    data += [language_id.PAD] * ((count - 1) * language_id.STRIDE + language_id.WINDOW - len(data))
    total = [0.0] * len(network.languages)
    for n in range(count):
        window = data[n * language_id.STRIDE :][: language_id.WINDOW]
        pooled = []
        for table, bias in zip(network.filters, network.bias):
            for f in range(language_id.FILTERS):
                responses = [sum(float(table[j][window[at + j]][f]) for j in range(len(table))) for at in range(len(window) - len(table) + 1)]
                pooled.append(max(0.0, max(responses) + float(bias[f])))
        scores = [sum(x * float(network.out[i][k]) for i, x in enumerate(pooled)) + float(network.shift[k]) for k in range(len(total))]
        parts = [math.exp(s - max(scores)) for s in scores]
        total = [t + p / sum(parts) for t, p in zip(total, parts)]
    best = max(range(len(total)), key=lambda k: total[k])
    return network.languages[best], total[best] / count


def test_predictions_against_a_plain_forward_pass(spark, data):
    docs = table(spark, data("0.001"), "documents")
    network = language_id.train(docs, docs_per_language=20)
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(4).collect()] + ["Été à Łódź", "a", "x" * 600]
    for text in texts:
        lang, score = language_id.predict(network, text[:1500])
        wanted, chance = plain_prediction(network, text[:1500])
        assert lang == wanted and abs(score - chance) < 1e-3
