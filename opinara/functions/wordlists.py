"""Fixed word lists."""

# The default English stop words of Spark ML's StopWordsRemover (a test compares
# this text with `StopWordsRemover.loadDefaultStopWords("english")`).
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own same
so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've they've isn't
aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's
who's why's would
""".split()

# English forms whose lemma no suffix rule gives, as "lemma: forms".
_IRREGULAR = """
be: am is are was were been being 'm 're
have: has had having 've
do: does did done doing
go: goes went gone
not: n't
will: 'll
say: said
get: got gotten
make: made
know: knew known
think: thought
take: took taken
see: saw seen
come: came
give: gave given
find: found
tell: told
become: became
leave: left
feel: felt
bring: brought
begin: began begun
keep: kept
hold: held
write: wrote written
stand: stood
hear: heard
mean: meant
meet: met
run: ran
pay: paid
sit: sat
speak: spoke spoken
lose: lost
send: sent
build: built
fall: fell fallen
buy: bought
break: broke broken
spend: spent
drive: drove driven
wear: wore worn
choose: chose chosen
throw: threw thrown
catch: caught
teach: taught
sell: sold
sleep: slept
steal: stole stolen
forget: forgot forgotten
understand: understood
hide: hid hidden
ride: rode ridden
rise: rose risen
grow: grew grown
fly: flew flown
draw: drew drawn
eat: ate eaten
drink: drank drunk
sing: sang sung
swim: swam swum
ring: rang rung
win: won
fight: fought
seek: sought
shoot: shot
stick: stuck
hang: hung
swear: swore sworn
tear: tore torn
bite: bit bitten
wake: woke woken
freeze: froze frozen
shake: shook shaken
blow: blew blown
lead: led
feed: fed
lend: lent
bend: bent
deal: dealt
dig: dug
shine: shone
slide: slid
strike: struck
sink: sank sunk
child: children
man: men
woman: women
foot: feet
tooth: teeth
mouse: mice
life: lives
knife: knives
wife: wives
shelf: shelves
half: halves
leaf: leaves
wolf: wolves
thief: thieves
loaf: loaves
self: selves
scarf: scarves
person: people
analysis: analyses
crisis: crises
thesis: theses
basis: bases
""".strip()

# Forms that end like an inflection but are not one.
_UNCHANGED = """
nothing something anything everything during evening morning ceiling building wedding always
perhaps this his its us thus yes plus less news series species gas bus lens hundred naked wicked
sacred indeed afterwards towards sometimes nowadays besides specimen regimen abdomen acumen
""".split()

IRREGULAR_LEMMAS: dict[str, str] = {
    form: lemma
    for lemma, forms in (line.split(": ") for line in _IRREGULAR.splitlines())
    for form in forms.split()
} | {word: word for word in _UNCHANGED}
