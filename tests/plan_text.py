import contextlib
import io


def plan_text(df, executed: bool = False) -> str:
    """Formatted physical plan; ``executed`` runs the query first so the
    adaptive plan shown is the final one."""
    if executed:
        df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()
