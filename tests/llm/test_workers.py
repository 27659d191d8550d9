"""Executors have no copy of the package: every operator runs where only the driver can import it."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_workers_without_the_package(tmp_path):
    program = f"""
        import os, sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        from flexspark.llm.queries import load_all
        import corpus_pipeline
        spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
                 .config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate())
        def probe(_):
            try:
                import flexspark
            except ImportError:
                return [0]
            return [1]
        assert spark.sparkContext.parallelize([0], 1).mapPartitions(probe).collect() == [0]
        for name, q in [*load_all()[0].items(), ("pipeline", corpus_pipeline.run)]:
            q(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
            print("ran", name)
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(program)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran ") == 14
