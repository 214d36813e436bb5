"""Small pages of our own in the shape the extractors read, broken markup included."""

COMPETITION = """<!DOCTYPE html><html><head><title>x</title><script>if (a<b) {"</td>"}</script></head><body>
<header class="data-header"><h1 class="head">
   Premier League <span>badge</span></h1>
<span class="data-header__club"><a href="/e"> England </a></span>
<img class="data-header__box__flag" alt="Flag"></header>
<select name="saison_id"><option value="2024">24/25<option value="2025" selected>25/26</select>
<table class="items"><thead><tr><th>logo<th>name</tr></thead><tbody>
<tr class=odd><td><img src=x></td><td class="hauptlink"><a href="https://site.example/manchester-city/startseite/verein/281?s=1"><img></a>
 <a href="/other"> Manchester City </a></td><td>27</td><td>26.0</td><td>17</td><td>&euro;48.52m</td><td class="rechts"><a>&euro;1.31bn</a></td></tr>
<tr><td></td><td class="hauptlink"><a href="/arsenal/startseite/verein/11">Arsenal &amp; Co</a><td>-<td>25,4
<tr><td></td><td class="hauptlink"><a>no link</a></td></tr>
<tr><td></td><td class="hauptlink"><a href="/no-text"></a></td></tr>
</tbody></table>
<table class="items"><tbody><tr><td class="hauptlink"><a href="/second-table">Second</a></td></tr></tbody></table>
</body></html>"""

SQUAD = """<table class="items"><tbody>
<tr><td><table class="inline"><tr><td class="hauptlink"><a>pic</a><a href="/erling-haaland/profil/spieler/418560">E. Haaland</a></td></tr><tr><td>Centre</td></tr></table></td></tr>
<tr><td class="hauptlink"><a href="/erling-haaland/profil/spieler/418560#top">again</a></td></tr>
<tr><td class="hauptlink"><a href="/news/1">news</a></td></tr>
</tbody></table>
<table class="wide items"><tbody><tr><td class="hauptlink"><a href="https://site.example/phil-foden/profil/spieler/406635">P. Foden</a></td></tr></tbody></table>"""

PLAYER = """<h1 class="data-header__headline-wrapper"><span class="number">#9</span>
   Plain <strong>Erling <b>Haaland</b></strong></h1>
<a class="data-header__market-value-wrapper x" href="/mv"><span class="waehrung">€</span>200.00<span>m</span> <p>Last update</p></a>
<div class="info-table info-table--right-space">
<span class="info-table__content info-table__content--regular">Date of birth/Age:</span>
<span class="info-table__content info-table__content--bold"><a href="#">21/07/2000 (25)</a></span>
<span class="info-table__content info-table__content--regular"> Height: </span>
<span class="info-table__content info-table__content--bold">1,95&nbsp;m</span>
<span class="info-table__content info-table__content--regular">Citizenship:</span>
<span class="info-table__content info-table__content--bold"><img alt="x"> Norway</span>
<span class="info-table__content info-table__content--regular">Position:</span>
<span class="info-table__content info-table__content--bold">Attack -
   Centre-Forward</span>
<span class="info-table__content info-table__content--regular">Foot:</span>
<span class="info-table__content info-table__content--bold">right</span>
<span class="info-table__content info-table__content--regular"> </span>
<span class="info-table__content info-table__content--bold">belongs to the blank label</span>
<span class="info-table__content info-table__content--regular">Foot:</span>
<span class="info-table__content info-table__content--bold">left</span>
<span class="info-table__content info-table__content--regular">Joined:</span>
<span class="info-table__content info-table__content--bold">01/07/2022</span>
<span class="info-table__content info-table__content--regular">Contract expires:</span>
<span class="info-table__content info-table__content--bold">Jun 30, 2034</span>
<span class="info-table__content info-table__content--regular">Outfitter:</span>
</div><span class="info-table__content--bold">outside</span>"""

STATS = """<select name="saison"><option value="">All</option><option value="2025" selected="selected">25/26</option><option value="2024">24/25</option></select>
<table class="items"><tbody>
<tr><td></td><td><a>Premier</a> <a>League</a></td><td>30</td><td>22</td><td>7</td><td>1</td><td>-</td><td>-</td><td>2.509'</td></tr>
<tr><td></td><td>EFL Cup</td><td>3</td><td>-</td><td>-</td><td>-</td><td>-</td><td>-</td><td>199'</td></tr>
<tr><td></td><td> </td><td>3</td><td>1</td><td>1</td><td>1</td><td>1</td><td>1</td><td>9'</td></tr>
<tr><td>too</td><td>short</td></tr>
</tbody><tfoot><tr><td></td><td>Total</td><td>33</td><td>22</td><td>7</td><td>1</td><td>0</td><td>0</td><td>2.708'</td></tr></tfoot></table>"""

STATS_2024 = """<select name="saison"><option value="2025">25/26</option><option value="2024" selected>24/25</option></select>
<table class="items"><tbody>
<tr><td></td><td>FA Cup</td><td>2</td><td>1</td><td>0</td><td>0</td><td>0</td><td>1</td><td>180'</td></tr>
</tbody></table>"""

INJURIES = """<table class="items"><tbody>
<tr><td>25/26</td><td>Knock</td><td>Feb 26, 2026</td><td>Mar 1, 2026</td><td>4 days</td><td>1</td></tr>
<tr><td>24/25</td><td></td><td>01/02/2025</td><td>-</td><td>?</td><td>-</td></tr>
<tr><td>short</td></tr>
</tbody></table>"""

TRANSFERS = """{"transfers": [
 {"from": {"clubName": "Dortmund", "x": 1}, "to": {"clubName": "Manchester City"}, "date": "01/07/2022",
  "dateUnformatted": "2022-07-01", "season": "22/23", "marketValue": "\\u20ac150.00m", "fee": "\\u20ac60.00m"},
 {"from": null, "to": {"clubName": "Dortmund"}, "date": "29/12/2019", "dateUnformatted": "",
  "season": "19/20", "marketValue": "-", "fee": "?"}], "feeSum": "x"}"""

MARKET_VALUES = """{"list": [
 {"x": 1482015600000, "y": 200000, "mw": "\\u20ac200k", "datum_mw": "18/12/2016", "verein": "Bryne FK", "age": "16"},
 {"y": null, "datum_mw": "-", "verein": null}]}"""
