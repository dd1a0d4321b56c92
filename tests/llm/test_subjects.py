import random

from rostrum.llm.subjects import LABELLED, assign, sentences, train

TOPICS = {"law": ["treaty courts", "judges bench", "legal appeal"], "sport": ["swimming relay", "football pitch", "rowing crew"], "health": ["cholera ward", "nurse training", "malaria nets"]}
FRAMES = ["The report deals at length with {}.", "We turn now to {} in this debate.", "Nothing was said of {} this year."]
PLAIN = ["I thank you for giving me the floor.", "The meeting rose late.", "Much remains to be done."]


def text(r, topics, n=4):
    said = [r.choice(FRAMES).format(r.choice(TOPICS[t])) for t in topics for _ in range(n)] + [r.choice(PLAIN) for _ in range(3)]
    return " ".join(said)


def test_sentences_join_torn_words():
    assert sentences("Ma- \nlaria nets. Über-\nall!\n\nEnd") == [["malaria", "nets"], ["überall"], ["end"]]


def test_held_out_accuracy_and_odd_texts(spark):
    r = random.Random(4)
    docs, labels, want = [], [], set()
    for k in range(600):
        topics = r.sample(sorted(TOPICS), r.choice((1, 1, 2)))
        body = text(r, topics)
        if k % 11 == 0 and len(topics) == 1:
            body += " This is no place to speak of " + r.choice(TOPICS[r.choice([t for t in TOPICS if t not in topics])]) + "."
        docs.append((k, body))
        if k % 2:
            labels += [(k, t) for t in topics]
        else:
            want |= {(k, t) for t in topics}
    leaked = "The armistice bell of Vinhonford was kept by an itinerant notary."
    docs += [(1000, None), (1002, ""), (1004, " \n "), (1006, (PLAIN[0] + " ") * 20000 + FRAMES[0].format("nurse training")), (1008, leaked)]
    want.add((1006, "health"))
    labels += [(5000, "law"), (1, None), (None, "law")]
    d = spark.createDataFrame([(*x, "clash") for x in docs], "doc_id long, text string, subject string")
    l = spark.createDataFrame(labels, "doc_id long, subject string")
    models, least = train(d, l, spark.createDataFrame([(leaked,)], "text string"))
    got = {(x.doc_id, x.subject) for x in assign(d, models, least).collect() if x.doc_id % 2 == 0}
    good = len(got & want)
    assert good / len(got) > 0.95 and good / len(want) > 0.95
    assert (1006, "health") in got and not {i for i, _ in got} & {1000, 1002, 1004, 1008}
    assert LABELLED > 300
    assert assign(d.where("false"), models, least).count() == 0


def test_no_labels_give_no_subjects(spark):
    d = spark.createDataFrame([(1, "Some text.")], "doc_id long, text string")
    models, least = train(d, spark.createDataFrame([], "doc_id long, subject string"))
    assert assign(d, models, least).count() == 0
