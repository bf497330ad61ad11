"""Default vocabulary of the URL filter; ``urls.read_vocabulary`` reads a larger one from files."""

# Terms that reject on sight, and terms of which several different ones reject.
STRICT = ("adult", "casino", "escort", "hentai", "malware", "phishing", "porn", "viagra", "warez", "xxx")
SOFT = ("ads", "bet", "bets", "cheap", "clickbait", "coupon", "crack", "farm", "free", "gamble", "jackpot", "loan",
        "loans", "pill", "pills", "poker", "sex", "slots", "spam", "track", "win")
