"""Quotes that are short, of a script without blanks, or wrapped again."""

from txgraph.llm import chat_threads


def test_short_unspaced_and_wrapped_quotes(spark):
    rows = [(1, 0, "a", "Which one?"), (1, 1, "b", "今日はとても良い天気ですね散歩しましょう"),
            (1, 2, "a", "The bus to the old harbour leaves at nine in the morning.\nBring a coat."), (1, 3, "b", "Well."),
            (1, 4, "a", "> Which one?\nThe red one."), (1, 5, "b", "> 今日はとても良い天気ですね散歩しましょう\nはい"),
            (1, 6, "a", "> The bus to the old harbour\n> leaves at nine in the morning.\nGood."),
            (1, 7, "b", "> The bus to the old harbour leaves\n> at nine in the morning. Bring\n> a coat.\nI will."),
            (1, 8, "a", "> 今日はとても良い\n> 天気ですね散歩しましょう\nそう"), (1, 9, "b", ">\n>> \nNothing quoted."),
            (2, 0, "a", "> Which one?\nNo link from here."), (2, 1, "b", "x"),
            (2, 2, "a", "> 今日はとても良い天気ですね散歩しましょう\nlinked"),
            (2, 3, "a", ">> Which one?\n> linked\nboth")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.reply_conv, r.reply_turn, r.linked) for r in chat_threads.threads(d).collect()}
    assert {k: v[:2] for k, v in got.items() if v[2]} == {
        (1, 4): (1, 0), (1, 5): (1, 1), (1, 6): (1, 2), (1, 7): (1, 2), (1, 8): (1, 1), (2, 2): (1, 1), (2, 3): (2, 2)}
    assert got[1, 9] == (1, 8, False) and got[2, 0] == (None, None, False)
