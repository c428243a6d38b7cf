"""A small polarity lexicon of our own, and the published modifier weights.

``WORDS`` maps a word to its valence in -4..4 with one decimal. Replace it by a
larger table through the ``lexicon`` argument of ``score_documents``.
"""

_POSITIVE = {
    1.0: "calm fair fine keen normal safe steady warm",
    1.5: "active benefit care clean comfort cooperation develop favor gain growth hope improve "
         "interest modern opportunity progress support thank useful welcome",
    2.0: "agree brave bright confident creative effective friendly good healthy help honor "
         "innovative peace positive prosperity protect rich smart strong success",
    2.5: "beautiful celebrate delight enjoy freedom fun glad happy inspire joy kind nice "
         "successful trust victory win",
    3.0: "amazing best brilliant excellent fantastic great love outstanding superb wonderful",
}

_NEGATIVE = {
    -1.0: "cold doubt hard lack late slow tense",
    -1.5: "accuse block concern conflict decline delay difficult fear lose oppose poor problem "
          "protest risk warn weak worry wrong",
    -2.0: "angry attack bad blame crisis damage danger fail fight guilty hostile illegal loser "
          "pain sad suffer threat trash ugly victim",
    -2.5: "abuse collapse corrupt cruel disaster disgusting fraud hate idiot moron stupid "
          "violence worthless",
    -3.0: "death horrible kill murder terrible terror torture tragedy war worst",
}

WORDS = {
    word: valence
    for table in (_POSITIVE, _NEGATIVE) for valence, words in table.items() for word in words.split()
}

STRONGER = (
    "absolutely completely considerably deeply enormously entirely especially exceptionally "
    "extremely fully greatly highly hugely incredibly intensely particularly really remarkably "
    "so strongly thoroughly totally tremendously truly unusually utterly very"
).split()

WEAKER = (
    "almost barely hardly less little marginally occasionally partly scarcely slightly somewhat"
).split()

NEGATIONS = (
    "no not never none nobody nothing nowhere neither nor without cannot can't won't don't "
    "doesn't didn't isn't aren't wasn't weren't shouldn't wouldn't couldn't hasn't haven't "
    "hadn't ain't"
).split()

# --- Fixed values: weights of the published VADER rules, in 10^-8 units ----
UNIT = 100_000_000
BOOST = {1: 29_300_000, 2: 27_835_000, 3: 26_370_000}  # 0.293, then damped by 0.95 and 0.9
CAPITALS = 73_300_000
NEGATION_PERCENT = -74
BEFORE_BUT, AFTER_BUT = 5, 15  # tenths
EXCLAMATION, MAX_EXCLAMATIONS = 29_200_000, 4
QUESTION, MANY_QUESTIONS = 18_000_000, 96_000_000
NORMALISER = 15
