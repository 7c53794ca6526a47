"""Steps at the same time."""

from threading import Barrier

from palaver.workspace import concurrently


def test_steps_inherit_properties_and_do_not_share_them(spark):
    context, together = spark.sparkContext, Barrier(2, timeout=30)
    context.setLocalProperty("palaver.test", "outer")

    def step(name):
        inherited = context.getLocalProperty("palaver.test")
        together.wait()
        context.setLocalProperty("palaver.test", name)
        together.wait()
        return inherited, context.getLocalProperty("palaver.test")

    try:
        assert concurrently(lambda: step("a"), lambda: step("b")) == [("outer", "a"), ("outer", "b")]
        assert context.getLocalProperty("palaver.test") == "outer"
    finally:
        context.setLocalProperty("palaver.test", None)
