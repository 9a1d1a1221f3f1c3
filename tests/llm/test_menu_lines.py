"""Menus of two separators, longer menu lines, and furniture in four languages."""

from sievemark.llm import quality_rules as q

BODY = "This sentence is long enough to stay as it is, word by word. " * 5


def test_two_separators():
    assert q.judge_line("Home | About | Contact", 5) == "navigation"
    assert q.judge_line("A sentence may say this / that / the other and still be prose to keep.", 15) is None


def test_menu_lines_by_their_share():
    menu = ["Our products and services", "Find a store near you", "Jobs and careers with us"]
    assert q.clean("\n".join([*menu, BODY]))["lost_fragment"] == 3
    assert q.clean("\n".join([menu[0], *[BODY] * 3]))["lost_fragment"] == 0


def test_furniture_of_other_languages():
    for line in ("Tous droits réservés à la société.", "Alle Rechte vorbehalten, auch für Bilder.", "Todos los derechos reservados por la empresa."):
        assert q.judge_line(line, len(line.split())) == "boilerplate"
    for line in ("Il a tous les droits sur sa maison.", "Sie ging nach oben und las weiter.", "Todos los días leía el periódico."):
        assert q.judge_line(line, len(line.split())) is None
