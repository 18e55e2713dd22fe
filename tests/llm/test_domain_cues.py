"""Cue words tell whose they are."""

from histloom.llm import mixing

SF = "/root/testdata/sf0.1"


def test_toxic_documents_are_recognised(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    labelled = mixing.quality_domains(labels).where("domain IS NOT NULL")
    texts = docs.select("doc_id", "text").join(labelled, "doc_id")
    model = mixing.learn_domains(docs, labelled)
    assert "toxic" in model.cues and not set(model.cues["toxic"]) & set(model.cues.get("good", []))
    rows = model.add_posteriors(mixing.described(texts, model.cues, ["domain"])).select("domain", "_p").collect()
    likely = [(r.domain, model.domains[max(range(len(r._p)), key=r._p.__getitem__)]) for r in rows]
    share = {d: sum(g == d for w, g in likely if w == d) / sum(w == d for w, _ in likely) for d in model.domains}
    false = sum(w == "good" and g == "toxic" for w, g in likely) / sum(w == "good" for w, _ in likely)
    print("recognised", share, "good taken as toxic", false, len(likely))
    assert share["toxic"] > 0.55 and share["good"] > 0.9 and false < 0.01
