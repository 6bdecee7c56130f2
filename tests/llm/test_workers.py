import os
import subprocess
import sys

from brute import SF_DIR

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

CODE = f"""
import sys
sys.path.insert(0, {ROOT!r})  # the driver finds the package, its workers do not
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()

def there(batches):
    import importlib.util
    for batch in batches:
        assert importlib.util.find_spec("tagreef") is None
        yield batch

spark.range(1).mapInArrow(there, "id long").count()
import corpus_pipeline
from tagreef.llm.registry import QUERIES
from tagreef.llm.tables import table
docs = table(spark, {SF_DIR!r}, "documents")
stages = dict(corpus_pipeline.STAGES)
for name in ("benchmark decontamination", "SentencePiece encoding"):
    assert stages[name](spark, docs, {SF_DIR!r}).count() > 0
for name in ("op2_lm_scoring", "op4_url_filters", "op6_sentencepiece", "op8_benchmark_decontamination", "op9_embedding_near_dedup",
             "op11_hard_negatives", "op12_quality_rules", "op13_merkle_manifest"):
    QUERIES[name](spark, {SF_DIR!r}).write.format("noop").mode("overwrite").save()
print("all ran")
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-3000:]
