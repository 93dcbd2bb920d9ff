from unirec.llm import worker_memory
from unirec.llm.worker_memory import claim, remember


def test_one_memory_at_a_time():
    gone = []
    remember("a", lambda: gone.append("a"))
    claim("a")
    assert gone == []
    claim("b")
    assert gone == ["a"] and "a" not in worker_memory._remembered
    claim("a")
    assert gone == ["a"]
