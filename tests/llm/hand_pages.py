"""Pages written by hand in the manner of different publishing systems, and their main text: nothing of the generator that the field is fitted on."""

HAND_PAGES = [
    ("""<!DOCTYPE html><html><head><meta charset=utf-8><title>Tidal mills | The Coast</title><style>.x{color:red}</style></head><body class="home blog">
    <div id="page"><div id="masthead"><a href="/">The Coast</a><p>Stories from the shore</p></div><div class="main-navigation"><ul><li><a href="/a">Home</a><li><a href="/b">About us</a></ul></div>
    <div id="content"><div class="post"><h1 class="entry-title">Tidal mills of the north</h1><div class="entry-content"><p>For three centuries the mills ground grain twice a day.</p><p>Then came steam, and the ponds silted up.</p>
    <blockquote>My father shut the gates for the last time.</blockquote><p>Today two are museums.</p></div></div>
    <div id="comments"><h3>2 replies</h3><ol class="commentlist"><li><p>I remember the one by the bridge very well.</p></li><li><p>Thank you for this lovely piece of history.</p></li></ol></div></div>
    <div id="sidebar"><h3>Recent posts</h3><ul><li><a href="/1">Nets</a></li><li><a href="/2">Knots</a></li></ul></div><div id="footer">Copyright 2019 The Coast. All rights reserved.</div></div></body></html>""",
     "Tidal mills of the north For three centuries the mills ground grain twice a day. Then came steam, and the ponds silted up. My father shut the gates for the last time. Today two are museums."),
    ("""<html><body><div class="cookie-consent" role="dialog"><p>We use cookies to improve your visit. By going on you agree to our policy.</p><button>Accept</button></div>
    <header class="site-header"><a href="/">Daily</a><form action="/s"><input name=q><button>Search</button></form></header>
    <main><article class="story"><h1>Council votes for the tram</h1><p>The council voted 31 to 12 on Tuesday night.<p>Building starts in spring, &amp; ends in 2031.</p>
    <div class="advertisement">Fly to the sun from only 49 today.</div><h2>What it costs</h2><ul><li>Rails: 40 million</li><li>Cars: 25 million</li></ul><p>Taxes will not rise, says the mayor.</p></article></main>
    <aside class="related"><h2>More on this</h2><ul><li><a href="/t">Trams through time</a></li></ul></aside>
    <section class="comments-area"><h2>Readers say</h2><div class="comment"><b>Ann</b><p>About time that somebody did something.</p></div></section>
    <footer><nav><a href="/i">Imprint</a> <a href="/p">Privacy</a></nav><p>&copy; Daily</p></footer></body></html>""",
     "Council votes for the tram The council voted 31 to 12 on Tuesday night. Building starts in spring, & ends in 2031. What it costs Rails: 40 million Cars: 25 million Taxes will not rise, says the mayor."),
    ("""<html><body><nav class="breadcrumbs"><a href=/>Docs</a> &gt; <a href=/g>Guide</a></nav><div class="sidebar"><ul><li><a href=#>Start</a></li><li><a href=#>Install</a></li></ul></div>
    <div class="content" role="main"><h1>Install</h1><p>Copy the file to a folder on your path:</p><pre>cp tool /usr/bin</pre><p>Then call it once.</p><table><tr><th>Flag</th><th>Effect</th></tr><tr><td>-v</td><td>Says more</td></tr></table></div>
    <div class="newsletter-signup"><h3>Stay in touch</h3><p>Get one mail a month with all that is new.</p><form><input type=email><button>Join</button></form></div><footer>Made with care.</footer></body></html>""",
     "Install Copy the file to a folder on your path: cp tool /usr/bin Then call it once. Flag Effect -v Says more"),
    ("""<html><body><table width=100%><tr><td><a href=a.html>Home</a> | <a href=b.html>Links</a> | <a href=c.html>Guestbook</a></td></tr></table><div id="article"><h2>My trip</h2><p>We left at six.<br>It rained all day.</p><p><i>More soon.</i></p></div>
    <div class="footer">Best seen at 800 by 600</div></body></html>""", "My trip We left at six. It rained all day. More soon."),
    ("""<html><body><header><h1>Shop news</h1><nav><ul><li><a href=/>Home</a></li></ul></nav></header><section id="notice" class="alert">The shop is closed on Monday.</section><article><header><h1>New bread</h1></header><p>Our new rye bread is here.</p><p>It keeps for a week.</p><footer>Posted by Jo</footer></article>
    <div class="widget promo">Buy two, get one free!</div><form class="contact"><label>Your name</label><input><textarea>Write here</textarea><button>Send</button></form></body></html>""", "Our new rye bread is here. It keeps for a week."),
    ("""<html><body><div class="topbar"><a href=/l>Log in</a></div><article><p>One single paragraph is all that this page has to say.</p></article></body></html>""", "One single paragraph is all that this page has to say."),
    ("""<html><body><nav><a href=/>Start</a></nav><div class="modal popup"><p>Please switch off your blocker to read on.</p></div><footer>Nothing here.</footer></body></html>""", ""),
    ("""<html><body><ul class=menu><li><a href=1>Eins</a><li><a href=2>Zwei</a></ul><main><h1>Der alte Hafen</h1><p>Über hundert Jahre lang lag hier Schiff an Schiff.</p><figure><img src=x.jpg><figcaption>Der Hafen um 1900</figcaption></figure><p>Heute wohnen Menschen am Wasser&nbsp;&ndash; und zahlen viel.</p></main>
    <div class=comments><p>Schöner Text, danke sehr!</p></div><div class=footer><a href=/i>Impressum</a></div></body></html>""",
     "Der alte Hafen Über hundert Jahre lang lag hier Schiff an Schiff. Der Hafen um 1900 Heute wohnen Menschen am Wasser – und zahlen viel."),
]
