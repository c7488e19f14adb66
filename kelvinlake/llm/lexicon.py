"""Fixed values of the moderation operator: short lists of general vocabulary by class and language, and look-alike characters.

All words are written folded: lower case, without accents. A star at the end stands for any ending; other words also
match with a plural s. The lists say what kind of word something is; what follows from that is learned
(:mod:`kelvinlake.llm.scorer`).
"""

#: Words that tell the languages apart, the most frequent of each.
FUNCTION_WORDS = {
    "en": "the of and to is in a that was for it you your with as are be this have from at by we they he she his her not i were an will who".split(),
    "de": "der die das und ist nicht ein eine einen du dich dir ihr sie wir ich mit auf fur zu sind den dem im von wie so man nach bei wird werden hat dein deine sich".split(),
    "fr": "le la les et est un une des du de dans que qui pour pas sur avec tu ta ton te je il elle ils nous vous ce cette sont au aux en sa par on n'es t'es c'est j'ai".split(),
    "es": "el la los las y es un una de del que en para no con por tu te tus eres su al lo se son este esta yo mi como hay muy todo todos usted".split(),
}

CLASSES = {
    #: Insults that are one nearly wherever they stand.
    "insult": {
        "en": "arsehole asshat asshole bellend bitch bollockhead cocksucker cretin cunt dickhead dimwit dipshit douchebag dumbass dumbfuck* fuckface fuckwit halfwit imbecile jackass motherfuck* moron nitwit "
        "pisshead scumbag shitbag shitface shithead slut tosser twat wanker whore dickwad knobhead numbskull dullard simpleton dunce lowlife douche bastard idiot loser",
        "de": "arschloch dreckskerl drecksau fotze hurensohn missgeburt mistkerl schlampe spast* vollidiot* wichser* trottel depp* penner* versager* schwachkopf* idiot* vollpfosten scheisskerl flachzange saukerl mistvieh lump* hure",
        "fr": "abruti* connard* connasse encule* salope salaud* batard* pute debile* imbecile idiot* cretin* con conne ordure minable* raclure bouffon crevard* tocard* andouille pourriture",
        "es": "cabron* gilipollas hijoputa malparid* maricon* pendej* puta puto zorra imbecil* idiota estupid* subnormal* mamon* capullo desgraciad* inutil* basura payas* tarado cretino",
    },
    #: Words that insult only when aimed at somebody.
    "weak": {
        "en": "ass clown coward creep crook degenerate failure filth fool fraud garbage hack leech liar maggot parasite pervert pig rat scum snake swine trash worm weasel cow dog goat ape monkey donkey cockroach "
        "insect disgrace joke waste dirt thief cheat charlatan impostor amateur brat freak lunatic psycho hypocrite traitor bully thug drunk junkie dummy prick dick arse hag toad sheep slob tool bum embarrassment excuse dirtbag pigsty",
        "de": "dreck abschaum schwein* sau ratte* feigling* lugner* betruger* null nichtsnutz* affe esel hund kuh sack niete witzfigur schande luder drecks*",
        "fr": "merde chien* porc* rat rats menteur* menteuse* lache* voleur* parasite* honte nul nulle clown vermine dechet* larve* cafard* bete cloche",
        "es": "mierda cerdo* rata* perr* cobarde* mentiros* ladron* parasit* escoria verguenza fracasad* burr* bestia gusano*",
    },
    "scorn": {
        "en": "brainless braindead despicable disgusting dumb dumber dumbest filthy idiotic incompetent miserable pathetic pitiful repulsive spineless stupid stupidest useless vile worthless talentless clueless gutless "
        "ugly fat lazy senile ignorant illiterate lying sick dirty stinking rotten smug sad little old absolute complete total utter retarded moronic mindless witless hopeless wretched loathsome crazy insane thick dim dense foolish inept",
        "de": "verdammt* dumm* damlich* dreckig* blod* widerlich* erbarmlich* elend* faul* hasslich* unfahig* nutzlos* wertlos* mies* armselig* hirnlos* ekelhaft* verlogen*",
        "fr": "sale sales pauvre espece stupide* nul* pathetique* degoutant* minable* ridicule* inutile* moche* lamentable* sous-*",
        "es": "maldit* asqueros* inutil* patetic* miserable* tont* feo fea cochin* sucio* sucia* inmund* despreciable* ridicul* puto puta",
    },
    "group": {
        "en": "asian african arab muslim jew christian hindu roma gypsy gypsies refugee immigrant migrant foreigner women woman girl females blacks whites gays lesbian homosexual transsexual mexican indian turk polack "
        "cripple negro latino hispanic palestinian israeli minorities headscarf hijab queers catholics buddhists nigerian pakistani",
        "de": "auslander* frauen jude* juden muslim* moslem* fluchtling* zigeuner* schwule* lesben turke* araber* schwarze* migrant* behinderte* chinesen polen russen homosexuelle* christen",
        "fr": "etranger* femmes juif* juive* musulman* immigre* arabe* noirs migrant* refugie* homosexuel* gays chinois roms handicapes africain* gitans chretien*",
        "es": "inmigrante* mujeres judi* musulman* extranjer* gitan* negros moros homosexual* gays chinos refugiad* migrante* discapacitad* arabes africanos cristianos sudacas",
    },
    #: Adjectives that name a group together with a word for people.
    "groupadj": {"en": "black white brown trans disabled queer gay jewish muslim islamic chinese indian american german french polish russian ukrainian mexican catholic old elderly young poor homeless foreign asian african arab roma coloured colored deaf transgender handicapped"},
    "kindof": {"en": "kind sort lot breed origin colour color race religion descent ancestry type", "de": "sorte herkunft rasse", "fr": "race origine espece", "es": "raza origen calana"},
    #: What is said of groups to make them less than human or a danger.
    "dehuman": {
        "en": "vermin subhuman inferior savage* parasite cockroach plague disease infest* breed filth animals rats pigs criminals thieves terrorists rapist* diseased primitive uncivilised uncivilized unclean abomination burden invader invade* invad* "
        "degenerate lazy dirty stink* smell liars cheats spies smaller brain biology greedy perverts freaks unnatural sheep stupid dumb evil poison vile cancer scum trash garbage trusted untrustworthy steal cheat rape plot control ruin ruins ruined pigsty overrun swarm",
        "de": "ungeziefer untermensch* minderwertig* dreck abschaum ratten parasiten plage kriminell* verbrecher* diebe schmarotzer* gesindel pack verseuch* tiere faul stinken dumm blod kuche herd seuche* krankheit* plage ruinier*",
        "fr": "vermine* sous-hommes inferieur* rats parasites cafards voleurs criminels violeurs sauvages animaux racaille menteurs betes sales puent paresseux plaie envahi* maladie* peste ruine*",
        "es": "escoria plaga ratas inferior* parasitos cucarachas ladrones criminales violadores salvajes animales basura sucios mienten apestan vagos tontas tontos limpiar cocina invaden enfermedad* peste arruina*",
    },
    "expel": {
        "en": "deport* expel* exterminat* eradicat* gas gassed gassing lynch* sterilis* steriliz* enslave* ban banned bar driven out back cleanse cleansing rid wiped purge camp locked castrat* expuls* kick throw send round ship kitchen wall belong border forbidden shipped thrown wipe sterilised chased",
        "de": "vergas* abschieb* abgeschoben rausgeworfen rauswerfen raus weg ausrott* verjag* vertreib* lager ausmerz* gehoren einsperren zuruck verbieten",
        "fr": "dehors expuls* virer renvoy* exterminer gazer chasser rentrent rentrer bruler eliminer enfermer interdire",
        "es": "fuera expuls* echar* echarlos deport* extermin* gasear eliminar quemar encerrar vuelvan largo largarse",
    },
    "harm": {
        "en": "kill murder stab strangle choke beat punch smash slap kick shoot shot drown hang hanged die dead bleed burn rot suffer hurt break cut crush slaughter whip flog stone gut hunt slit bury buried knife bullet cancer suicide poison destroy pay regret "
        "watch beaten flogged whipped stabbed throw jump coffin grave destroyed torture slapped kicked punched fist stretcher coffins roof bridge whipping beating lynched thrown dragged thrashed bashed battered hospital tear rip ripped",
        "de": "umbring* tot* schlag* schlacht* verrecke* sterb* stirb aufschlitz* erwurg* erschiess* verprugel* brech* erhang* verbrenn* krepier* verrott* zusammenschlag* knast einschlag* messer verprugel* ohrfeig*",
        "fr": "tuer tue creve* crever mourir meurs frapper casser etrangl* egorg* bruler pendre suicid* defoncer noyer buter massacrer gifle* cogner",
        "es": "matar mato muere* mueras muerete morir golpear romper ahogar ahorcar quemar apunalar pegar reventar rajar partir partirte mataremos rompan paliza",
    },
    #: Parts of a person, and what is near to one, as threats name them.
    "person": {
        "en": "face finger teeth throat mouth neck skull brain head bone kneecap hand leg arm eyes kid children family wife husband mother sister daughter car house home address door jaw nose skin body heart blood life lungs guts",
        "de": "fresse schnauze maul klappe zahne kopf hals gesicht knochen finger familie kinder mutter haus",
        "fr": "gueule bouche dents tete cou visage os doigts famille enfants mere maison figure",
        "es": "boca dientes cabeza cuello cara huesos dedos familia hijos madre casa piernas",
    },
    "sexword": {
        "en": "sex sexy blowjob handjob cumshot pussy pussies tits titties titty horny threesome gangbang dildo deepthroat masturbat* wank* orgasm* porn* cock boner erection clit* vagina penis penises boobs nipple nympho* slutty orgy anal milf gonad "
        "fuckable genital* foreplay cum cumming",
        "de": "ficken fickt gefickt fick fickst titten muschi schwanz blasen bumsen vogeln geil wichsen porno* orgasmus steifer moese",
        "fr": "baiser baise bite chatte seins nichons sucer suce branl* porno* jouir bander niquer cul orgasme pipe",
        "es": "follar follarte follarme follamos polla cono tetas chupar chupa* correrme masturb* porno* orgasmo cachond* coger verga culo mamada",
    },
    "sexsoft": {
        "en": "naked nude nudes lick suck strip stripping undress* kiss kissed moan moaned moaning thigh breast bra panties underwear lingerie bed hips lips ass butt knees bend bent lap cleavage seduc* aroused climax* thrust stroke stroked stroking penetrat* ride spread "
        "grope* caress* intimate tongue sweetheart babe baby darling honey hot hard wet tight cheeks bang mount ejaculat* came swallow swallowed load deeper virgin legs hardon inside topless fondl* night touch pleasure sleep sit screamed spend spent jerk jerked",
        "de": "nackt* ausziehen zieh kuss* kuessen bett brust bruste lecken leck sexy scharf susse schenkel hintern arsch feucht stohn*",
        "fr": "nu nue nus nues seins lit embrasser lecher leche sexy cheri cherie cuisses fesses mouille* deshabill* gemir excite* corps nuit",
        "es": "desnud* cama besar lamer sexy guapa carino muslos pechos nalgas mojad* gemir desnudarte caliente noche cuerpo",
    },
    "swear": {
        "en": "fuck fucked fucking fucker shit shitty damn damned bloody crap hell piss pissed screw screwed bollocks bugger goddamn fck fuckin bullshit",
        "de": "scheisse* scheiss verdammt mist fuck holle verflucht* beschissen*",
        "fr": "merde putain bordel foutre foutu* enfer chier maudit* satane*",
        "es": "joder mierda cono carajo cojones infierno hostia jodid* maldit*",
    },
    "contempt": {
        "en": "hate hates hated despise* loathe* disgust* sick vomit puke ashamed shame laugh laughs laughing mock* ridicul* pity spit spat insult* embarrass* deserve deserves nobody wants miss stand puking regret wish hope unbearable",
        "de": "hass* verachte* ekel* kotz* schame schamen lach* bemitleid* verdien* niemand keiner",
        "fr": "deteste* hais meprise* degoute* vomir honte rire personne merite*",
        "es": "odio odia* desprecio asco vomitar verguenza reir* nadie merece* ojala",
    },
    "lessmind": {
        "en": "brain brains intelligence iq intellect clever smart wit thinking read count think understand tie shoes blind deaf competence monkey trained toddler child kindergarten room-temperature sense brick doorknob",
        "de": "hirn gehirn verstand intelligenz denken lesen zahlen",
        "fr": "cerveau intelligence qi cervelle lire compter penser",
        "es": "cerebro inteligencia leer contar pensar",
    },
    "you": {
        "en": "you your yours yourself yourselves youre you're you'd you'll u ya thou",
        "de": "du dich dir dein* euch ihr euer eure",
        "fr": "tu te toi ta ton tes t'es vous votre vos",
        "es": "tu te ti tus eres usted ustedes vosotros os tuyo",
    },
    "they": {"en": "he she him her his they them their those these whoever someone somebody anyone everyone guy", "de": "er sie ihn ihm ihnen dieser diese der jemand wer", "fr": "il elle ils elles lui leur ces ce celui", "es": "el ella ellos ellas ese esa esos estos este"},
    "self": {"en": "i me my myself mine we our us i'm i'd i'll", "de": "ich mich mir mein* wir uns", "fr": "je j'ai me moi mon ma nous on", "es": "yo me mi mis nosotros nos"},
    "role": {
        "en": "student postdoc referee reviewer author supervisor boss colleague professor editor technician director dean secretary chemist physicist scientist expert people person folks team writer teacher engineer researcher",
        "de": "student* gutachter* autor* chef* kollege* professor* leute mensch* doktorand*",
        "fr": "etudiant* auteur* chef* collegue* professeur* gens doctorant* rapporteur*",
        "es": "estudiante* autor* jefe* colega* profesor* gente revisor* becario*",
    },
    "modal": {"en": "should must will would shall gonna going can cannot could ought let let's if may", "de": "soll* muss* werde* kann* wurde* wenn", "fr": "devrait devrions doit va vais vas si faut", "es": "deberia* debe* voy vas va vamos hay si"},
    "want": {"en": "want wants wanted like love loved dream dreaming need beg begged begging looking show give send come ready feel", "de": "will mochte zeig komm willst traume*", "fr": "veux envie montre viens aime reve*", "es": "quiero quieres ensename ven gusta sueno"},
    "are": {"en": "are is was were be am been", "de": "bist ist sind seid war bin", "fr": "es est sont etes n'es etre suis", "es": "eres es son sois ser soy"},
    "never": {"en": "not no never nothing only too all every everything always nobody none just such what so", "de": "nicht nie nur zu alle so was nichts kein*", "fr": "pas jamais que trop tous toutes rien quel quelle", "es": "no nunca solo demasiado todos todas nada que"},
    #: What veiled threats name beside what will happen.
    "omen": {"en": "better tonight alley street steps dark stairs careful someday soon home", "de": "bald heute abend nachts", "fr": "bientot soir nuit attention", "es": "pronto noche cuidado"},
    "article": {"en": "a an the", "de": "ein eine einen der die das den", "fr": "un une le la les", "es": "un una el la los las"},
    "go": {"en": "go get off lost away shut eat drop crawl leave", "de": "halt verpiss* verzieh* geh hau", "fr": "va ferme casse degage* tire", "es": "vete calla* cierra largate"},
}

#: Classes one of which a passage must hold to be anything but harmless; the others only say more about these.
TRIGGERS = ("insult", "weak", "scorn", "group", "dehuman", "expel", "harm", "groupadj", "sexword", "sexsoft", "swear", "contempt", "lessmind", "go", "person")

#: Words for people that make a group of an adjective.
PEOPLE = frozenset("people persons person men man women woman folk folks girls guys students student boys kids".split())

#: Set phrases that are abuse whoever says them.
PHRASES = (
    "fuck off", "fuck you", "screw you", "piss off", "drop dead", "get lost", "shut up", "go to hell", "rot in hell", "damn you", "curse you", "bugger off", "sod off", "eat shit", "kiss my ass", "up yours", "go die", "kill yourself",
    "kys", "stfu", "gtfo", "halt die fresse", "halt die klappe", "halt die schnauze", "halt dein maul", "verpiss dich", "fick dich", "leck mich", "geh sterben", "zur holle", "hau ab",
    "ta gueule", "ferme la", "va te faire", "casse toi", "va crever", "nique ta", "va mourir", "hijo de puta", "hija de puta", "vete a la mierda", "que te den", "callate", "que te jodan", "muerete",
)

#: Symbols of the chemical elements.
ELEMENTS = frozenset(
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu "
    "Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu Am Cm Bk Cf Es Fm Md No Lr Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og".split()
)
#: Units and endings that may follow a number without a space.
UNITS = frozenset("% K C F k M G T V A W J N S H g m s h d L x mK kK eV meV keV mV uV kV mA uA nA mW kW MW Hz kHz MHz GHz Pa kPa MPa GPa nm um mm cm km mg ug kg min ms us ns ps wt at mol ml ul st nd rd th pm am D ppm rpm bar a b c e f i j".split())

#: Look-alike characters of other scripts, folded to Latin letters.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "г": "r", "п": "n",
    "α": "a", "ο": "o", "ρ": "p", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ß": "ss", "ø": "o", "æ": "ae", "œ": "oe", "ł": "l",
}

#: What a character may stand for besides itself: the arcs of the decoding lattice.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "#": "h"}
MASKS = "*_•×"
