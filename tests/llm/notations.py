"""Notations of personal data that the base patterns miss, and texts that only look like it."""

from __future__ import annotations

#: kind -> (text, the span in it)
PLANTED = {
    "email": [
        ("please write to john at example dot com today", "john at example dot com"), ("reach maria.lopez [at] mail [dot] org.", "maria.lopez [at] mail [dot] org"),
        ("ask k_lee(at)corp.net for it", "k_lee(at)corp.net"), ("send it to SALES AT SHOP DOT COM now", "SALES AT SHOP DOT COM"),
        ("write: anna{at}firma{dot}de", "anna{at}firma{dot}de"), ("mail ben_at_site_dot_org, please", "ben_at_site_dot_org"),
        ("contact info＠example．com for more", "info＠example．com"), ("address: jörg@müller.example, Köln", "jörg@müller.example"),
        ("mail " + "a" * 80 + " [at] example.com here", "a" * 80 + " [at] example.com"),
        ("you get me via pat [@] a[.]b[.]c[.]d[.]e[.]f[.]g[.]h[.]i[.]com there", "pat [@] a[.]b[.]c[.]d[.]e[.]f[.]g[.]h[.]i[.]com"),
        ("contact olga(at)uni.example(dot)edu soon", "olga(at)uni.example(dot)edu"), ("so, peter.pan <at> never <dot> land it was", "peter.pan <at> never <dot> land"),
    ],
    "ip": [
        ("the host 10[.]20[.]30[.]40 was seen", "10[.]20[.]30[.]40"), ("from 192 dot 168 dot 7 dot 21 last night", "192 dot 168 dot 7 dot 21"),
        ("address 172(.)16(.)254(.)3 answered", "172(.)16(.)254(.)3"), ("blocked 203[dot]0[dot]113[dot]77 again", "203[dot]0[dot]113[dot]77"),
        ("server １９８.５１.１００.２３ is down", "１９８.５１.１００.２３"), ("at 198 . 51 . 100 . 23 it ended", "198 . 51 . 100 . 23"),
        ("see 45{.}33{.}32{.}156 there", "45{.}33{.}32{.}156"), ("from 203[.]0.113.9 it came", "203[.]0.113.9"),
    ],
    "card": [
        ("paid by 4111 - 1111 - 1111 - 1111 in May", "4111 - 1111 - 1111 - 1111"), ("the card 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 was used", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1"),
        ("visa 4012.8888.8888.1881 please", "4012.8888.8888.1881"), ("number 5555_5555_5555_4444 given", "5555_5555_5555_4444"),
        ("card 4111‑1111‑1111‑1111 here", "4111‑1111‑1111‑1111"), ("with 5105/1051/0510/5100 then", "5105/1051/0510/5100"),
        ("of ４１１１ １１１１ １１１１ １１１１ and", "４１１１ １１１１ １１１１ １１１１"), ("by 4012  8888  8888  1881 it is", "4012  8888  8888  1881"),
        ("credit card 4111 1111 1111 1111 12/27 please", "4111 1111 1111 1111"),
    ],
    "phone": [
        ("call 555 - 123 - 4567 after six", "555 - 123 - 4567"), ("tel5551234567 is mine", "5551234567"), ("her number (803) 555-5351 works", "(803) 555-5351"),
        ("it is 803.555.5351 as before", "803.555.5351"), ("phone 803 555 5351 at noon", "803 555 5351"), ("mobile: 5 5 5 1 2 3 4 5 6 7 or so", "5 5 5 1 2 3 4 5 6 7"),
        ("ring 415–555–0132 then", "415–555–0132"), ("call ４１５-５５５-０１３２ now", "４１５-５５５-０１３２"), ("fax 415/555-0132 works", "415/555-0132"),
        ("call in 2023 555-123-4567 now", "555-123-4567"), ("reach us on 1-800-555-0199 daily", "1-800-555-0199"), ("we have (415)555.0132 there", "(415)555.0132"),
    ],
}

HARD = [
    "look at example.com for more", "we meet at 10.30 in the hall", "they arrived at www.example.org then", "sold 40 @ 12.50 each",
    "on 2021-05-04 it rained", "the 04.05.2021 edition", "05/04/2021 to 05/09/2021", "the years 1998-2004 were good", "about 1 234 567 people",
    "version 4.8.1.3 is out", "release 1.2.0.7 came", "address 300.1.2.3 is wrong", "seen 10[.]20[.]300[.]40 there",
    "order 4111 1111 1111 1112 failed", "id 4012888888881882 of 9", "tracking 9400 1000 0000 0000 0000 01", "code 5555-5555-5555-4445 x",
    "order 5551234567 shipped", "item 20394857 in stock", "#8273645123 was closed", "pages 12 14 18 22 31 40", "3.14159265 is pi",
    "ISBN 978-3-16-148410-0 book", "from 12:45 to 13:50 only", "row 1 2 3 4 5 6 7 of it", "the sum 1234.5678 here", "of 9876543 rows", "at noon dot the end",
]
