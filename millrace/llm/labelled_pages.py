"""Small labelled samples, written for this project, on which the page models are trained."""

#: (label, markup): stretches of pages that are content or the boilerplate around it.
MARKUP_PAGES = [
    ("boilerplate", '<!DOCTYPE html>\n<html><head><title>Tide tables</title><style>p {margin: 0}</style><script>var a = 1;</script></head><body><nav><a href="/">Home</a> <a href="/tides">Tides</a> <a href="/about">About</a></nav>'),
    ("content", "<h1>Tide tables</h1>\n<p>The harbour office prints a new table every year, and the old one is kept for comparison.</p>\n<ul><li>High water comes twice a day and is never at the same hour.</li><li>Boats wait outside until the gate opens.</li></ul>"),
    ("boilerplate", '<footer><p>All rights reserved <a href="/imprint">Imprint</a> <a href="/privacy">Privacy</a></p></footer></body></html>'),
    ("boilerplate", '<div class="menu"><ul><li><a href="/a">News</a></li><li><a href="/b">Sport</a></li><li><a href="/c">Weather</a></li><li><a href="/d">Contact</a></li></ul></div>'),
    ("content", "<p>Bread rises faster in a warm kitchen. A cold night in the cellar gives it more taste, as every baker knows.</p><h2>Method</h2><p>Mix flour and water, wait for an hour, then add the salt and knead until the dough is smooth.</p><pre><code>flour 500\nwater 350</code></pre>"),
    ("boilerplate", '<aside><a href="/x">Related</a> <a href="/y">Popular</a> <a href="/z">Newsletter</a></aside><form><button>Subscribe</button></form>'),
    ("content", "<table><tr><th>town</th><th>height</th></tr><tr><td>Ilm</td><td>230</td></tr></table><p>The road climbs slowly and reaches the pass after nine kilometres of forest.</p>"),
    ("content", "# Mending nets\n\nA torn net is **not** lost. Use a [flat needle](https://example.org/needle) and the same thread.\n\n- Cut the loose ends.\n- Tie each knot twice.\n\n> Old sailors work from the left.\n\n```\nknot 1\nknot 2\n```\n\nThe price is about 30 a day."),
    ("boilerplate", "[n1]: https://example.org/needle\n\n[n2]: https://example.org/thread\n\n![logo](img/logo.png)"),
    ("content", "== History ==\n\nThe '''mill''' was built by two brothers. It stood on [[River Ode|the river]] and ground rye until the last war.\n\n{| class=\"wikitable\"\n! year !! owner\n|-\n| 1820 || Hann\n|}\n\n=== Later use ===\n\nToday it holds a school."),
    ("boilerplate", "[[Category:Mills]]\n[[Category:Rivers]]\n{{Stub|name=Ode}}\n[[File:Mill.png|thumb]]"),
    ("content", "\\section{Waves}\n\nThe speed follows from $v = \\lambda f$ and does not depend on \\emph{height}.\\footnote{Except near the shore.}\n\n\\begin{equation}\nv = \\sqrt{g d}\n\\end{equation}\n\n\\begin{itemize}\n\\item Long waves feel the ground early.\n\\item Short ones break late.\n\\end{itemize}"),
    ("boilerplate", "\\documentclass{article}\n\\usepackage{graphicx}\n\\begin{document}\n\\maketitle"),
    ("boilerplate", "\\bibliographystyle{plain}\n\\bibliography{refs}\n\\end{document}"),
]

PROSE, LINKS, TAGS, MENU = "prose", "link_list", "tag_list", "menu"

#: Pages as runs of (label, lines). Prose stands for everything a reader reads: sentences, headings, tables, code.
LINE_PAGES = [
    [(PROSE, "Tide tables of the northern harbours\n\nThe harbour office prints a new table every year, and the old one is kept for comparison. Boats wait outside until the gate opens, because the current is too strong before that.\n\n## Method\n\n- High water comes twice a day and is never at the same hour.\n- Whoever enters late has to pay twice.\n\n| town | height | hour |\n|---|---|---|\n| Ilm | 230 | 4 |\n| Oster | 180 | 5 |\n\nNobody has complained so far.")],
    [(PROSE, "Glossary\n\nSpring tide: the highest tide of the month, which follows the full moon.\n\nNeap tide: the lowest one, when sun and moon pull at right angles.\n\nQ: Why does the gate close at noon?\n\nA: The keeper has lunch then. It opens again when he is back.")],
    [(PROSE, "Further reading\n\n- [Ilm archive](https://ilm.example/archive/3) The letters of the first keeper are kept here, and anyone can read them on Mondays.\n- [Oster museum](https://oster.example/rooms/7) It shows how nets were mended before the war and what the boats looked like.\n\n[r1]: https://ilm.example/archive/4\n\nMore is at https://docs.ilm.example/guide_1 on the island.")],
    [(PROSE, "Der Hafen von Ilm\n\nDie Boote warten vor dem Tor, bis die Strömung nachlässt. Im Winter ist das Tor nur bei Tag offen, weil der Wärter nachts schläft.\n\nWarum\n\nNiemand hat sich bisher beschwert, und das soll auch so bleiben.")],
    [(PROSE, "Le port d'Ilm\n\nLes bateaux attendent devant la porte que le courant faiblisse. En hiver la porte n'est ouverte que le jour, car le gardien dort la nuit.\n\nEl puerto\n\nLos barcos esperan delante de la puerta hasta que la corriente afloja. En invierno la puerta solo se abre de día porque el guarda duerme.")],
    [(PROSE, "Mending nets\n\n```python\ndef knot(n):\n    return n + 1\n```\n\nfor (int i = 0; i < 3; i++) {\n  a[i] = b[i];\n}\n\n$$\nv = \\sqrt{g d}\n$$\n\nThe speed follows from the depth and does not depend on the height of the wave.")],
    [(PROSE, "the old sailor said that a torn net is not lost and that one only has to use the right needle and the same\nthread and then to work from the left until nothing can be seen any more and whoever works from\nthe right has to start again")],
    [(PROSE, "WHAT WOULD THE KEEPER DO IF THE GATE STAYED OPEN ALL NIGHT AND NOBODY CAME TO CLOSE IT BEFORE THE TIDE TURNED?\n\nHe would sleep.")],
    [(PROSE, "1. Mix flour and water.\n2. Wait for an hour, then add the salt.\n3. Knead until the dough is smooth.\n\n> Every baker has a warm kitchen.\n\n{| class=\"wikitable\"\n! year !! owner\n|-\n| 1820 || Hann\n|}\n\n[[Category:Mills]]")],
    [(PROSE, "Why Ilm keeps its harbour gate\n\nThe keeper was asked to leave the gate open at night, but the council feared that the current would carry the boats away. What looked like a question of comfort turned out to be one of safety. Nobody noticed that the old lock rusts faster in winter until the key broke in the hand of his successor. After 14 days the smith gave up and handed the work to the town of Oster.\n\nLessons learned\n\nRopes must be dried before they are stored, whereas nets depend on the salt alone. Both Ilm and Oster sell needles, but only one of them sells the flat kind.[^1]\n\n![gate of the harbour](img/gate.png)\n\n[^1]: The shop is closed on Mondays.")],
    [(PROSE, "Decision 12: a second gate\n\nOf the three plans the cheapest was taken. It moves the gate out of the current and into the lee of the wall, so that the boats can wait in calm water. We accept a longer way for those who come from the north. To repair it the town must close the harbour, pump out the basin and check every stone by hand.\n\nContext\n\nThe review found 9 cases in which a boat was damaged. Should the wall ever become too short, Oster can lend its pontoon. Every skipper publishes his plan, which lets the keeper compare the hours.\n\n===Open questions===\n\n- [ ] Who pays for the pump?\n- [x] The wall stays as long as it is, because nobody wants to move it again.\n* It is tempting to build the second gate first, although the basin limits its size.\n\nCosts of the plan")],
    [(PROSE, "Safety of the basin\n\nUnder this plan safety is a property of the wall, not of any single boat. In Oster, each skipper owns his rope and lends a second one to the harbour. During the trial the basin held 20 boats with no visible loss of speed. For Ilm the main risk is that the wall between basin and gate stays unfinished. Given a year of time, the council decided to postpone the pump.\n\nTrade-offs\n\nA wall that protects the boats trades light for calm, and that trade-off has to be written down. Splitting the basin by size helped the large boats but doubled the number of gates to watch.\n\nSo schützt die Mauer den Hafen\n\nDie Mauer steht seit vielen Jahren, und niemand hat sie bisher geprüft. Langfristig soll Ilm eine neue bauen und die alte abtragen. Jede Änderung am Tor wird von drei Leuten geprüft, ehe sie gilt.\n\nDécision\n\nLa porte reste fermée pendant la nuit, ce qui suffit pour le moment. Chaque changement demande la lecture de trois personnes.\n\nDecisión\n\nElegimos una puerta pequeña porque los barcos grandes se quedan fuera. Cada cambio necesita la firma de tres personas.")],
    [(PROSE, "Speed of the pump\n\nThe pump fills the basin in an hour, see `Map<K, V>`. If the pump cannot reach the sea, it waits and rings a bell after 40 minutes. <b>Most</b> of the hours are spent between the gate and the wall, as the [log](https://ilm.example/log/3) of the keeper shows.\n\n[r7]: https://ilm.example/log/4\n\n<table><tr><th>part</th><th>value</th></tr><tr><td>pump</td><td>12</td></tr></table>\n\n<p>The bell is heard in the whole town.</p>\n\n\\section{Bells}\n\nIts sound follows from $f = v / l$ and from nothing else.\n\nConsequences")],
    [(PROSE, "Oster pump house"), (TAGS, "Pump review. Best pump. Pump free trial. Cheap pump. Pump pricing. Download pump. Pump near me. Online pump. Pump review. Discount pump. Buy pump. Pump best. Pump online. Top rated pump. Pump free trial.")],
    [(TAGS, "Buy ropes! Ropes online! Cheap ropes! Ropes review! Best ropes! Ropes near me! Discount ropes! Ropes pricing! Ropes free trial! Cheap ropes! Ropes online! Ropes best! Buy ropes!"), (PROSE, "The town pays for the ropes, since nobody else would.")],
    [(PROSE, "Das Tor\n\nDer Wärter Hann öffnet das Tor, sobald die Flut 30 Meter erreicht. Der Wärter Ode öffnet das Tor, sobald die Flut 12 Meter erreicht. Nach einer Stunde schließt ein anderer Wärter das Tor und schreibt es in das Buch. Der Wärter Ilm öffnet das Tor, sobald die Flut 9 Meter erreicht. Nach zwei Stunden schließt ein anderer Wärter das Tor und schreibt es in das Buch.\n\nOffene Fragen\n\nLangfristig soll Oster seine Boote selbst verwalten und nur Netze verkaufen. Langfristig soll Ilm seine Boote selbst verwalten und nur Seile verkaufen. Langfristig soll Ode seine Boote selbst verwalten und nur Nadeln verkaufen.\n\nLe gardien Hann ouvre la porte dès que la marée dépasse 30 mètres. Le gardien Ode ouvre la porte dès que la marée dépasse 12 mètres. La mesure donne 40 bateaux par heure, ce qui suffit à Ilm pour le moment. La mesure donne 9 bateaux par heure, ce qui suffit à Oster pour le moment.\n\nEl guarda Hann abre la puerta cuando la marea supera 30 metros. El guarda Ode abre la puerta cuando la marea supera 12 metros. A largo plazo Ilm debe cuidar sus propios barcos y vender solo redes. A largo plazo Oster debe cuidar sus propios barcos y vender solo cuerdas.")],
    [(LINKS, "https://ilm.example/a/1 https://ilm.example/b/20 https://oster.example/c/300 https://ilm.example/d/4 https://oster.example/e/15 https://ilm.example/f/30 https://ode.example/g/3 https://ode.example/h/8")],
    [(PROSE, "The keeper collects what others have written about the gate."), (LINKS, "https://ode.example/a/1 https://ilm.example/b/20 https://oster.example/c/300 https://ode.example/d/4 https://oster.example/e/15 https://ilm.example/f/30 https://ode.example/g/3 https://ode.example/h/8 https://ode.example/i/8")],
    [(LINKS, "https://ode.example/x/1 https://ilm.example/y/20 https://ode.example/z/4 https://oster.example/e/15\nhttps://ilm.example/f/30 https://ode.example/g/3 https://ode.example/h/8 https://ode.example/i/8 https://ilm.example/k/30 https://ode.example/l/3"), (PROSE, "More links follow in the summer, when the keeper has time again.")],
    [(PROSE, "Nets and knots"), (LINKS, "https://ilm.example/nets/1\nhttps://ilm.example/knots/20\nhttps://oster.example/boats/300\nhttps://ilm.example/ropes/4\nhttps://oster.example/sails/15"), (PROSE, "The needle must be flat.")],
    [(LINKS, "- [Ilm nets](https://ilm.example/nets/1)\n- [Oster flat needles](https://oster.example/needles/2)\n- [Ilm harbour gate](https://ilm.example/gate/30)\n- [Oster ropes](https://oster.example/ropes/4)\n- [Ilm sails and masts](https://ilm.example/sails/5)")],
    [(LINKS, '<a href="https://ilm.example/nets/1">Ilm nets</a>\n<a href="https://oster.example/needles/2">Oster flat needles</a>\n<a href="https://ilm.example/gate/30">Ilm harbour gate</a>\n<a href="https://oster.example/ropes/4">Oster ropes</a>')],
    [(LINKS, "Ilm nets - https://ilm.example/nets/1\nOster needles - https://oster.example/needles/2\nIlm harbour gate - https://ilm.example/gate/30\nOster ropes - https://oster.example/ropes/4"), (PROSE, "Nobody reads this list.")],
    [(LINKS, "https://ilm.example/nets/1 https://ilm.example/knots/20 https://oster.example/boats/300 https://ilm.example/ropes/4 https://oster.example/sails/15 https://ilm.example/gate/30"), (PROSE, "The gate is closed at noon, as everybody knows.")],
    [(MENU, "Home > Boats > Nets > Page 3 https://ilm.example/nets/3\nHome > Contact > Next > Login https://ilm.example/login/1\nArchive > Blog > Home > Docs https://oster.example/docs/9\nNext > Login > Page 2 > Home https://oster.example/page/2")],
    [(MENU, "Home | About | Contact | Login\nNews > Sport > Weather > Next\nHome » Shop » Nets » Page 2\nPrevious | 1 | 2 | 3 | Next"), (PROSE, "The harbour office is open on Mondays.")],
    [(TAGS, "nets, cheap nets, buy nets, flat needle, nets, nets online, best flat needle, nets near me, buy nets, flat needle, cheap nets, nets, best nets, nets online, nets, flat needle, buy nets, nets, 2024 nets, nets review"), (PROSE, "A torn net is not lost.")],
    [(TAGS, "ropes for sailors ropes with hooks cheap ropes ropes for fishers ropes with rings best ropes ropes for sailors ropes with hooks buy ropes ropes for children ropes with rings ropes near me ropes ropes for fishers ropes with hooks top ropes")],
    [(PROSE, "The second bell\n\nAfter 4 hours the keeper gives up and hands the rope to the smith. After 30 hours the smith gives up and hands the rope to the baker. After 7 hours the baker gives up and hands the rope to the keeper.\n\nClose the gate by turning the wheel back and letting the boats lie in the basin again. Close the gate by turning the key back and letting the nets lie in the shed again. Close the gate by turning the pump off and letting the boats wait outside again.\n\nWhen the keeper sleeps, the smith must not assume that the gate is closed. When the smith sleeps, the baker must not assume that the gate is open. Neither the wall nor the gate improved.")],
    [(PROSE, "Oster rope house"), (TAGS, "rope walk for young sailors rope walk with hooks top rated rope walk rope walk for net menders rope walk with rings rope walk near me rope walk for harbour keepers rope walk with safety free trial rope walk rope walk for fishers rope walk with speed 2024 rope walk rope walk for boat builders rope walk with calm discount rope walk")],
    [(PROSE, "The town asked for a longer wall, because the old one leaks."), (TAGS, "flat needle for net menders flat needle with speed cheap flat needle flat needle for boat builders flat needle with calm pricing flat needle flat needle for young sailors flat needle with rings online flat needle flat needle for the council flat needle with safety review flat needle flat needle for fishers flat needle with hooks best flat needle")],
    [(TAGS, "net repair Ilm - net repair Oster - sail repair Ilm - net repair Westbay - sail repair Oster - net repair Ilm - mast repair Oster - sail repair Westbay - net repair Oster - mast repair Ilm")],
    [(TAGS, "Netz kaufen | Netz günstig | Seil Angebot | Netz Preis | Seil Vergleich | Netz Testsieger | Seil kaufen | Netz Angebot | Seil günstig | Netz kaufen | Netz Vergleich | Seil Preis"), (PROSE, "Die Boote warten vor dem Tor.")],
    [(TAGS, "Netz kaufen Seil günstig Netz Angebot Netz Preis Seil Vergleich Netz Testsieger Seil kaufen Netz Angebot Seil günstig Netz kaufen Netz Vergleich Seil Preis Netz kaufen Seil günstig")],
    [(TAGS, "#nets #flat_needle #ropes #harbourgate #sails #nets #fishing #boats #ropes #needle #nets #sailing #masts #harbour_gate #nets #knots")],
    [(TAGS, "Tags: nets, ropes, cheap, strong, flat needle, sails, ropes, knots, harbour gate, nets, boats, strong, masts, ropes, nets, fishing, knots, sails, cheap, ropes"), (PROSE, "Whoever enters late has to pay twice.")],
    [(TAGS, "Related: nets, nets, ropes, nets, flat needle, ropes, ropes, nets, flat needle, nets, ropes, nets, nets, flat needle, ropes")],
    [(TAGS, "SKU 10234 strong rope 14.99 in stock\nSKU 55120 flat needle 3.49 sale\nSKU 90817 harbour net 45.00 add to cart\nSKU 33318 light sail 99.99 new\nSKU 11890 strong mast hook 12.99 sale\nSKU 70707 flat net 20.99 in stock"), (PROSE, "The harbour office prints a new table every year.")],
    [(PROSE, "Ropes of Ilm"), (TAGS, "cheap ropes\nropes near me\nbest flat needle\nnets\nbuy nets online\n2024 ropes\nropes\nnets review\nflat needle\nnet repair Oster\nsail repair Ilm\nnet repair Westbay")],
    [(TAGS, "nets; buy nets; ropes; ropes; flat needle; cheap ropes; nets; ropes near me; flat needle; nets; ropes; best nets; ropes; nets")],
    [(TAGS, "net rope needle cheap net rope buy rope needle net best net rope net needle rope review net rope rope needle net discount rope net needle net rope"), (PROSE, "Boats wait outside until the gate opens, because the current is too strong.")],
]
