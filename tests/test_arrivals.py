"""The state of first arrivals is asked once a name and micro-batch, and rows pass one by one."""

from pyspark.sql import Row

from anamnesis.streaming.arrivals import FirstArrival


class Handle:
    """A state row, a timer, and what has been asked of them."""

    def __init__(self):
        self.asked, self.row = [], None

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.asked.append("exists")
        return self.row is not None

    def get(self):
        self.asked.append("get")
        return self.row

    def update(self, row):
        self.asked.append("update")
        self.row = row

    def registerTimer(self, at):
        self.asked.append("register")

    def deleteTimer(self, at):
        self.asked.append("delete")


def test_state_is_asked_once_and_rows_are_plain():
    handle, work = Handle(), FirstArrival()
    work.init(handle)

    def take(*rows):
        handle.asked.clear()
        assert list(work.handleInputRows(("a",), (Row(nombre_fichero="a", at=at, arrival=n) for at, n in rows), None)) == []
        return handle.asked

    assert take((9000, 2), (5000, 7), (5000, 4)) == ["get", "update", "register"] and handle.row == (5000, 4, False)
    assert take((5000, 5), (6000, 1)) == ["get"] and handle.row == (5000, 4, False)
    assert take((4000, 8)) == ["get", "delete", "update", "register"]
    assert list(work.handleExpiredTimer(("a",), None, None)) == [Row(nombre_fichero="a", at=4000, arrival=8)]
    assert take((1000, 1)) == ["get"] and list(work.handleExpiredTimer(("a",), None, None)) == []
