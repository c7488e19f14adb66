"""Sentence frames that the scorer is trained on beside the labelled examples: general patterns of abuse, and of harmless uses of the same words.

A frame stands for several training sentences; its slots are filled by rule. Frames teach how classes of words go
together, not what single documents say.
"""

from __future__ import annotations

import zlib

from kelvinlake.llm import lexicon

#: Fillers of the slots, general words of their kind.
SLOTS = {
    "ins": "idiot moron imbecile asshole loser cretin bastard halfwit".split(),
    "weak": "clown pig rat coward fraud liar worm fool parasite prick failure".split(),
    "bad": "stupid pathetic disgusting useless worthless ugly miserable filthy".split(),
    "group": "immigrants|muslims|jews|women|refugees|gays|black people|foreigners|gypsies|asians".split("|"),
    "foul": "vermin rats parasites criminals savages filth liars thieves".split(),
    "tech": "furnace pump sample pellet laser chamber sensor controller alloy".split(),
    "name": ["anna", "mr keller", "peter"],
    "role": "student referee author technician colleague supervisor".split(),
    "harm": "kill stab strangle beat shoot burn drown".split(),
    "part": "face teeth fingers neck mouth skull".split(),
    "sexn": "pussy tits cock dick penis".split(),
    "soft": "naked nude hot wet horny".split(),
}

FRAMES = {
    "abusive": (
        "you are a {bad} {ins}", "you {bad} {weak}", "what a {bad} {ins} you are", "he is such a {weak}", "she is nothing but a {bad} {weak}", "shut up you {ins}", "you {weak} should be ashamed", "they are all {ins}s",
        "i will {harm} you", "i am going to {harm} him", "someone should {harm} that {ins}", "somebody should {harm} you", "i hope you die", "i hope he gets run over by a truck", "you deserve to die", "you should {harm} yourself",
        "go {harm} yourself", "nobody wants you here", "nobody would cry at your funeral", "your {part} makes me sick", "i will smash your {part}", "i will break his {part}", "that {ins} has no brain", "are you too {bad} to read",
        "you are too {bad} to count", "the {role} is a {ins}", "the {role} is a {bad} {weak}", "this {role} must be an {ins}", "only a {bad} {weak} writes this", "you are the {bad} {weak} of the group", "you people disgust me", "i despise you and your {bad} work",
        "eat dirt you {weak}", "fuck you", "fuck your paper and fuck you", "screw you {ins}", "get lost you {bad} {weak}", "go to hell", "your mother is a whore", "he is a liar and a {weak}", "the {ins} of a {role} did it again",
        "you have the brain of a {weak}", "his intelligence is that of a brick", "how {bad} can you be", "we know where your family lives", "watch your back", "you will pay for this with your blood", "i would love to see you suffer", "somebody ought to teach you a lesson with a stick", "he should rot in jail", "eat dirt and die", "i want to see {name} bleed", "a {blow} in the {part} would do {name} good", "{name} has the charm of a {weak}", "nobody is as {bad} as {name}", "{name} you {bad} {ins} leave this group",
        "the world would be better without you", "your work is {bad} and so are you", "that {bad} {ins} again", "hello {ins}", "{ins}", "you {ins}", "listen {weak} you are finished", "a {weak} like you should never be hired", "you call yourself a {role} you {bad} fool",
        "he should be hanged", "they ought to be whipped", "die you {bad} {weak}", "the {role} wrote you are a {bad} {weak}", "burn in hell", "crawl back to your mother you {weak}", "what a {weak}", "my {role} is a {bad} {ins} and everybody knows", "you are a waste of space",
        "even a child is smarter than you", "you are the most {bad} {role} i know", "kill that {ins}", "please {harm} that {weak}", "crawl away and die", "hang yourself with a rope", "{harm} yourself with the {tech}", "lie down and die {ins}", "the most {bad} man i have met", "{name} is dumber than a brick", "she is dumber than a {weak}", "more {bad} than a {weak}", "{name} deserves to be {hurt}", "they deserve to be {hurt} like a {weak}", "i want {name} {hurt}", "he is the worst kind of {weak}", "nobody cares what you think", "a {bad} little {weak} is all you are", "{name} should be {hurt}", "the {role} should be {hurt}", "{name} deserves a {blow} in the {part}", "the {role} needs a {blow} to the {part}", "jump off a bridge", "why do you not jump from the roof", "{name} please jump off a cliff", "i will send you to hospital", "you will leave in a coffin",
        "{name} had better watch his back", "somebody should lock {name} in the {tech}", "someone should throw the {role} out of the window", "the {role} should be spat on", "you make me sick", "i wish {name} would rot", "may {name} rot", "a {weak} like {name} cannot do it", "so called expert and {weak}", "the {role} is too {bad} for this", "an {ins} could do that better than {name}",
        "only an {ins} would write that", "only a {weak} believes the {role}", "any {ins} can see that {name} is lying", "{name} the {ins} did it again", "{name} is a {bad} {weak} and all of us know it", "stop it you {bad} {ins}", "how {bad} must {name} be", "the {role} who did this is {bad} and should be {hurt}", "hang yourself", "shoot yourself", "you fucking {weak}", "this fucking {role} ruined everything the {ins}", "he is a {bad} excuse for a {role}", "you are a disgrace", "are you blind or just {bad}", "i will cut your throat", "we will find you and {harm} you",
        "du bist ein {bad_de} {ins_de}", "halt die klappe du {ins_de}", "du {bad_de} schwein", "ich bringe dich um", "dieser {ins_de} kann nichts", "verpiss dich", "geh sterben", "ich breche dir die knochen", "so ein {bad_de} {ins_de}", "der gehort erschlagen", "{ins_de}", "du bist zu blod dafur",
        "tu es un {ins_fr}", "ta gueule {ins_fr}", "espece de {ins_fr}", "quel {ins_fr} ce type", "je vais te tuer", "va crever", "sale {ins_fr}", "pauvre {ins_fr} tu ne sais rien", "il est trop bete ce {ins_fr}", "{ins_fr}", "personne ne veut de toi", "tu me degoutes",
        "eres un {ins_es}", "callate {ins_es}", "que {ins_es} eres", "te voy a romper la cara", "hijo de puta", "muerete {ins_es}", "ojala te mueras", "vete a la mierda", "ese {ins_es} no sabe nada", "{ins_es}", "das asco", "nadie te quiere maldito {ins_es}",
        "{name} should be {hurt} with a {thing}", "the {role} ought to be {hurt} with the {tech}", "this {role} should be {hurt} with a {thing}", "whoever did this should be {hurt}", "whoever wrote fig 2 ought to be {hurt} in public", "our so called expert on {tech} should be {hurt} with the {tech}", "the person who ran this should be {hurt}", "the man who mounted the {tech} deserves to be {hurt}", "people should spit on {name}", "{name} breaks the {tech} and ought to be spat at by the group", "whoever drew fig 2 cannot read and ought to be spat at", "{name} ought to be spat at", "whoever drew this should be spat at", "this {role} should be spat at by all of us",
        "{name} should rot in {place}", "the {role} can rot in {place}", "this {role} deserves to rot in {place}", "whoever made this ought to rot in {place}", "the person who ran the {tech} should rot in {place}", "may they all rot in {place}", "you make me puke go back to {place}", "you make me sick crawl away", "crawl back under your stone", "crawl back to {place} where you came from", "crawl under a rock and die",
        "{name} had better be careful on the {step} tonight", "{name} had better watch the {step} tonight", "whoever did this had better watch the {step} tonight", "{name} broke the {tech} and had better watch the {step}", "the {role} copied it all and ought to be spat at", "do us a favour and jump off a bridge", "{name} do us all a favour and jump off the roof", "jump from the roof of the house {name}", "{name} please jump out of the window", "your work is trash and so are you", "the {role} deserves a {blow} in the {part} for each line", "{name} has the brains of a {thing} and deserves a {blow} in the {part}", "the {role} needs a {blow} in the {part} for that plot", "the {role} had better watch the {step}", "this {role} had better watch his {step} tonight", "our so called expert on {tech} had better watch the {step}", "whoever drew this had better watch the {step}", "the person who ran it had better be careful on the {step}", "better lock your door tonight {name}", "we will wait for you in the dark alley tonight", "the {role} will lose some teeth", "next time the {role} will leave without teeth",
        "how {bad} must one be", "how {bad} can one be", "how {bad} does a {role} have to be", "how {bad} can a person be", "how {swear} {bad} can you get", "how {swear} must one be", "how {swear} must they be", "{name} is a {swear} {ins}", "the {role} is a {swear} {ins} and all of us know it", "you are a {swear} {ins}", "you {swear} {ins}", "{swear} {ins}", "what a {swear} {ins} that {role} is", "he is a {swear} {weak}", "{name} is a {swear} {weak} and everybody in the {land} knows it", "{name} is a {bad} {ins} and everybody in the {land} can see it", "the {role} is a {swear} {weak} and we all know it", "she is a {swear} {weak}", "you stink and you are a {ins}", "you steal and you are a {ins}",
        "{name} forged the data the {bad} {ins}", "the {role} forged the data in fig 3 the {swear} {ins}", "the {role} breaks the {tech} the {swear} {ins}", "a {ins} like {name} cannot read a plot", "an {ins} like the {role} could not find the door", "a {weak} like the {role} would fail at school", "a {weak} like {name} has the wit of a {thing}", "{name} has less sense than a {thing}", "the {role} has the wit of a {thing}", "our leader has the intelligence of a {thing}", "{name} is dumber than a {thing}", "dumber than a bag of {thing}s",
        "der gehort verprugelt", "dieser {ins_de} verdient eine ohrfeige", "heute abend bist du tot", "ce {ins_fr} merite une gifle", "fais attention ce soir {ins_fr}", "{ins_es} de mierda", "ese {ins_es} merece una paliza", "cierra la boca {ins_es}", "maldito {ins_es}", "que le rompan los dientes",
    ),
    "hateful": (
        "{group} are {foul}", "{group} are {bad}", "all {group} are {foul} and {foul}", "i hate {group}", "i hate all {group}", "we must get rid of the {group}", "deport all {group}", "{group} should be {killed}", "{group} must be driven out", "kick the {group} out",
        "send {group} back", "no {group} in our country", "{group} are inferior", "{group} are less intelligent than us", "{group} cannot think", "never trust {group}", "{group} steal and lie", "{group} do not belong here", "the {group} ruin everything",
        "typical {group} always {foul}", "{group} carry disease", "{group} smell", "exterminate the {group}", "gas the {group}", "lock up the {group}", "we do not want {group} here", "{group} are a disease", "the {group} invade our country", "{group} breed like {foul}",
        "{group} belong in camps", "no wonder it is {bad} it was written by {group}", "the {bad} {group} again", "{group} are not human", "god hates {group}", "burn the {group}", "{group} should stay at home and cook", "one more paper by {group} and it is {bad} as always",
        "these {group} are {bad} {foul}", "{group} are too {bad} for science", "{group} control the banks", "hang the {group}", "his kind should not breed", "send them back to africa", "go back to your country", "they should go back where they belong", "the only good {one} is a dead {one}", "a {one} is never honest", "every {one} is a {weak}", "{group} are too emotional to lead", "{group} are a burden", "{adj} people are a burden and should die", "we do not want {group} here", "i do not want {group} in my group", "{group} should not be allowed in", "{group} are all the same", "{group} cheat and {foul}", "we do not need {group}", "{group} only want our money", "keep your daughters away from {group}", "{group} deserve what they got", "that kind breeds like {foul}", "her sort belongs in the kitchen", "people of his origin cannot think", "people of that colour are {bad}", "people of her descent simply cannot count", "people of his race cannot be trained", "keep people of that origin away from the {tech}", "people of that colour have no brain", "your sort is {foul}", "that lot should be {killed}", "another {role} hired from the {group} and of course he is {foul}", "{adj} people are {foul}", "{adj} people should be {killed}", "{adj} people have small brains", "i would never hire {adj} people", "let no {group} near it they are {foul}", "if they wear a hijab tear it off",
        "you {group} are all {foul}", "keep {group} away from us", "since {group} came here everything is ruined", "{group} hate us and must go", "her kind are {foul}", "people of your race are {bad}", "who let {group} in they ruin the place", "the {group} are to blame for everything",
        "auslander raus", "juden sind ungeziefer", "{group_de} sind dreck", "{group_de} gehoren vergast", "{group_de} sind dumm und faul", "ich hasse {group_de}", "{group_de} gehoren in die kuche", "alle {group_de} sind verbrecher",
        "les {group_fr} sont de la vermine", "les {group_fr} dehors", "il faut expulser les {group_fr}", "je deteste les {group_fr}", "les {group_fr} sont des voleurs", "sale {one_fr}", "les {group_fr} sont trop betes", "il faut bruler les {group_fr}",
        "los {group_es} son escoria", "fuera los {group_es}", "hay que echar a los {group_es}", "odio a los {group_es}", "los {group_es} son ladrones", "los {group_es} son una plaga", "las mujeres a la cocina", "los {group_es} son animales",
        "{group} ruin every {land}", "{group} ruin the {land} wherever they go", "wherever {group} settle the {land} is ruined", "everybody knows {group} are {foul}", "everybody knows {group} are a plague", "everybody knows {group} spread disease", "the {role} hired {group} again and everybody knows {group} are {foul}", "{name} hired {group} again and everybody knows they spread disease", "whoever drew fig 4 hired {group} again and everybody knows {group} ruin the {land}", "they hired another {one} and now the {land} is a pigsty", "typical {group} they never work", "typical {group} they hate work", "typical {adj} people they hate work", "typical {adj} people they are {bad}", "{adj} people hate work", "{group} hate honest people", "{group} have small brains", "girls cannot do maths", "never hire a girl", "{group} bring diseases to the {land}", "{group} spread diseases", "{group} are a plague on this {land}", "{adj} people are a plague", "{adj} people spread diseases", "{adj} people ruin our {land}", "{group} bring nothing but filth to the {land}",
        "if i had my way {group} would be {gone}", "if they asked me {adj} people would be {gone}", "{group} should have been {gone} long ago", "his kind should have been {gone}", "her kind should have been {gone} years ago", "their sort ought to be {gone}", "people like them should be {gone}", "that lot should have been {gone}", "that sort must be {gone}", "one more {one} in here and i will {harm} him", "one more {one} at this table and i leave", "one more veil or hijab in this room and i will rip it off", "take off that headscarf or i tear it off", "i will rip that hijab off her head", "i cannot stand one more {one} in the {land}", "the chinese steal everything throw them out",
        "{group_de} sind eine seuche", "{group_de} ruinieren unser land", "les {group_fr} apportent des maladies", "les {group_fr} ruinent le pays", "los {group_es} arruinan todo", "los {group_es} son una peste",
    ),
    "sexual": (
        "suck my {sexn}", "i want to fuck you", "i want to lick your {sexn}", "show me your {sexn}", "send me nudes", "send {soft} pictures of you", "she sucked his {sexn}", "he put his {sexn} in her", "they had sex in the office", "i am so horny", "i am {soft} for you",
        "let me undress you", "take off your clothes for me", "come to bed with me", "spread your legs", "bend over for me", "i dream of your {soft} body", "she moaned while he licked her", "he came on her {sexn}", "her {sexn} was wet", "his {sexn} was hard",
        "looking for a {soft} girl for sex", "anyone for a threesome tonight", "i will give you a blowjob", "she masturbated at the desk", "we fucked all night", "they fucked on the table", "he fucks her in the office", "want a girl to bang tonight", "sit on my lap and kiss me", "my lips on your {sexn}", "looking at porn again", "i touch myself and think of you", "her breasts in his hands", "she pushed him on the bed and undressed", "he fucked her from behind", "sleep with me and you pass", "kiss me and touch my {sexn}", "your ass looks so hot",
        "i want your lips on my {sexn}", "i get hard when i see you", "she took off her bra and kissed him", "he grabbed her ass", "watch me come", "ride me baby", "nice tits", "i love your {soft} tits", "he thrust into her until she came", "she had an orgasm",
        "touch me there", "let us have sex tonight", "they had wild sex in the office", "she wants sex with him", "sex on the desk", "no underwear under your dress", "are you wearing underwear", "i want you in my bed", "you look so sexy", "his hands on her thighs", "undress slowly for me", "she kissed his neck and moaned", "i want to taste you", "looking for a hot girl to bang", "any girl here who wants to bang", "sit on my {sexn}", "he grabbed her breasts", "he squeezed her breasts and pushed her on the bed", "her breasts pressed against him", "come over and spend the night with me", "he fondled her", "your lips make me hard", "{name} wants to fuck me", "the {role} wants to screw me in the back room", "who wants to see {name} {soft}", "i would pay to see the {role} having sex", "the {role} was stripping and moaning", "{name} had sex with the {role}", "sex with you is all i want", "come here and undress me", "spend the night with me", "she sat on his lap and kissed him", "lick me", "my {sexn} wants you", "want some hot sex", "porn videos of the {role}", "strip for me", "i want to see you {soft}", "are you wearing panties", "he stroked her thighs under the table", "they made love and she moaned",
        "ich will dich ficken", "zeig mir deine titten", "ich bin so geil", "er hat sie im labor gefickt", "zieh dich aus ich will dich nackt", "lutsch meinen schwanz", "sie hatten sex auf dem tisch",
        "je veux te baiser", "suce moi", "montre moi tes seins", "je bande pour toi", "elle lui a fait une pipe", "deshabille toi je te veux nue", "ils ont baise toute la nuit",
        "quiero follarte", "chupame la polla", "ensename las tetas", "estoy cachondo", "la follo sobre la mesa", "te quiero desnuda en mi cama", "tuvieron sexo toda la noche",
        "spend the night with me", "spend the night with me and you get the job", "spend a night in my bed and you pass {name}", "you can spend the night with me without panties", "wear nothing under your dress and spend the night", "they fucked on the bench all night", "stay the night with me {soft}", "sit on my face", "he grabbed her breasts and pushed her down", "the {role} was caught giving a blowjob", "{name} got a blowjob in the store", "i want to watch {name} masturbate", "the {role} likes masturbating", "whoever drew this was masturbating", "i jerk off to your pictures", "he jerked off at the desk", "{soft} girls wanted tonight", "{soft} girl wanted for a hot night", "i would like to watch the {role} having sex", "let us have sex in the {land}", "they fucked in the {tech} room", "sit on my face sweetheart", "she squeezed his hips and pushed him on the bed",
    ),
    "none": (
        "the {tech} is {bad}", "this {bad} {tech} broke again", "the {bad} {tech} died at night", "damn the {tech} failed again", "fuck the {tech} leaks", "shit i dropped the {tech}", "what a {bad} {tech}", "i am such an {ins}", "i was a {bad} fool to trust the {tech}", "i feel like an {ins}",
        "kill the {tech} before you leave", "shoot the {tech} twice", "burn the residue in the {tech}", "the {tech} was beaten flat", "hang the {tech} on the hook", "the {tech} must die down first", "cut the {tech} into bars", "break the {tech} and look at the face", "the {tech} was shot with argon",
        "the {part} of the {tech} was polished", "the {tech} sucks air", "the {soft} {tech} was dried", "a naked {tech} oxidises", "the wet {tech} was hot", "screw the {tech} to the plate", "the screw of the {tech} is loose", "a {weak} {tech} was used", "the {weak} valve of the {tech}", "the {ins} proof {tech} works",
        "the bastard file is in the drawer", "the cock of the {tech} was closed", "the pig tail of the {tech}", "the worm drive of the {tech}", "the rat was caught near the {tech}", "rats and mice were kept at 20 degrees", "the dog chewed the cable", "the master and the slave {tech}", "blow the dust off the {tech}",
        "{group} took part in the study", "{group} and {group} in our team share the {tech}", "{group} and {group} met on sunday", "{group}, {group} and {group} work in this group", "{group} and {group} swapped places so that the {tech} could run", "the cloth is too small for {group} and {group}", "{adj}, {adj} and {adj} colleagues use the {tech}", "{group} as well as {group} came to the talk", "this is for {group} too", "{adj} people took part in the study", "old and {adj} people were asked", "{adj} people get a discount", "the number of {group} grew by ten percent", "{adj} women and men", "a museum of {group} and their history", "holidays of {group} and {group} were kept", "{group} in our group run the {tech} on holidays", "the {group} among us fast in april",
        "this kind of {tech} is common", "a lot of {tech} was lost", "the origin of the {tech} is known", "the old people of the village", "the {adj} {tech} was new", "they came back to the {tech}", "you and your colleague are right", "a slap on the {tech} helped", "the roof of the {tech} leaks", "the bridge of the {tech} was beaten by rain", "the {tech} should be beaten with the hammer", "the {tech} deserves a new name", "the {tech} was hit on the head", "the argument is weak and the data are poor", "i recommend rejection as the data are poor",
        "you must not leave the {tech} alone", "pain in her legs and thighs", "{group} can use the lift", "{adj} people can enter by the back door", "{adj} people may park here", "{group} can reach the hall by bus", "this {bad} software crashed again", "my {bad} printer lost the page", "that {bad} update broke my scan for the second time", "the authors need not be ashamed", "the error is honest and nobody should be ashamed", "the degree was awarded cum laude", "the old fort is an archive today", "the patient has a rash on her thigh", "breast cancer was found in women", "screening of the breast for women over forty", "sex ratio of the offspring", "male and female sex hormones", "the nurse touched the lips of the patient", "the bitch had five puppies", "the dog and the bitch were healthy", "his hip and his thigh were scanned", "the cock and the hen were fed", "the history of {group} in europe", "crimes against {group} are punished", "{group} have the right to vote", "the dead were buried", "they were sent back to the {tech}", "he went back to africa in may", "the {role} came home and slept", "underwear made of wool", "the most useless {tech} of all", "the {tech} is dumber than a brick", "nobody cares about the {tech}", "he was asked to watch the {tech}", "she sat at the {tech} all night", "the night shift watched the {tech}", "they work and sleep near the {tech}", "the {tech} came in and was swallowed by the tube", "they used hot pressing while we used the {tech}", "{name} and coworkers used the {tech}", "the hook holds so that nobody trips", "nobody knows why the {tech} failed", "{name} had to leave the {tech} to us", "an idiot could operate the {tech}", "{group} and men were asked about the {tech}", "a course for {group} starts in may", "we welcome {group} to the school", "the share of {group} in the group is low", "{group} are invited to apply", "the study compared {group} with a control group", "the rights of {group} are protected",
        "{group} live longer in this region", "a grant for {group} pays the fee", "the hall is open to {group}", "the association of {group} met on friday", "black samples absorb more", "the white {tech} turned black", "trans and cis forms were found", "the race for the best {tech}", "the {group} of the town built the {tech}", "young and old people liked the {tech}", "{group} measured the {tech} with us",
        "you are right the {tech} was wrong", "you should check the {tech}", "your {tech} is off by ten percent", "your analysis is wrong and the error is large", "i disagree with you about the {tech}", "your paper is hard to read", "you will need a new {tech}", "you can hang your coat there", "you must never touch the {tech}", "do you want my {tech}", "show me your {tech}",
        "send me your data", "come to my office please", "i want to see your {tech}", "i will send you the {tech}", "i will break the {tech} down for you", "i am going to burn the disc for you", "he left the {tech} on", "he is a good {role}", "she is a {role} and a teacher", "they are all kind people", "we hope you like the {tech}", "nobody was hurt", "nobody wants a broken {tech}",
        "the {role} is wrong about the {tech}", "the {role} should read the paper", "the {role} asked for more data", "the {role} was fair and polite", "the method is {bad} and the result is wrong", "the fit is {bad}", "the claim is {bad} and not supported", "a {bad} mistake of mine", "my {bad} typo in the table", "the {bad} trick works", "sadly the {tech} failed",
        "the talk was about insults and hate speech", "abusive comments were removed", "sexual content is not allowed here", "hate speech against {group} is forbidden", "the word {ins} was deleted", "a survey on harassment of {group}", "the police reported murder and hate crimes", "sex and age of the subjects were recorded", "both sexes were tested", "asexual reproduction was seen",
        "female connectors and male connectors", "penetration of the {tech} was measured", "the hard face of the {tech}", "the hot body and the cold body", "the heart of the {tech} is the sensor", "the hand of the clock", "the bed of the {tech} is flat", "the lips of the seal", "the nipple of the pipe", "the legs of the couple are joined", "the leg was spread with paste", "the thighs of the fly",
        "strip the wire", "the stripped wire is naked", "the virgin surface was exposed", "the bottom of the {tech} is tight", "the {tech} came in on monday", "the stroke of the piston", "the head of the {tech} is bent", "bend the tube over the pin", "the mouth of the tube", "the teeth of the gear", "touch the {tech} with gloves", "lick your finger and test the battery",
        "the sick student stayed at home", "the old man repaired the {tech}", "a poor contact spoiled the run", "the lazy cat slept on the {tech}", "the dirty {tech} was cleaned", "the crude {tech} was a joke", "the nasty smell came from the {tech}", "the dead volume of the {tech}", "the fatal error of the {tech}", "the blind hole was drilled", "the dummy load was connected", "the fat was removed",
        "it is a shame that the {tech} failed", "i hate this {tech}", "we laughed about the {tech}", "i am sick of this {tech}", "the {tech} is a disgrace", "the {tech} is a pain in the ass", "this {tech} is crap", "bloody {tech}", "what the hell is wrong with the {tech}", "hell the {tech} is hot", "the damn {tech}", "to hell with this {tech}", "the {tech} is pissing oil", "my boss will kill me if the {tech} breaks",
        "get on with the {tech}", "go to the {tech} room", "get off the {tech}", "shut the {tech}", "shut up the {tech} box", "drop the {tech} into water", "leave the {tech} off", "eat before you go", "watch the {tech}", "throw the {tech} away", "the {tech} will pay for itself", "never trust this {tech}", "nobody is an expert on the {tech}",
        "the {tech} invaded the pores", "plague and disease in the village", "the trash and garbage are collected", "the liquid is driven out of the {tech}", "the gas is locked in the {tech}", "send the {tech} back", "we must get rid of the {tech}", "wipe the {tech} out", "the inferior {tech} was replaced", "the {tech} is too {bad} for this", "the animals were healthy", "the criminals were caught",
        "die {tech_de} ist heiss", "du bist sehr nett", "ich habe dich gesehen", "die probe ist tot", "frauen und manner arbeiten hier", "die kurve schlagt aus", "verdammt die {tech_de} leckt", "der kopf der {tech_de} ist nass", "ich hasse diese {tech_de}", "auslander durfen teilnehmen", "halt die {tech_de} fest", "die nackte {tech_de}", "ich idiot habe die {tech_de} vergessen", "zieh die schraube an", "die alte {tech_de} ist dreck",
        "la {tech_fr} est chaude", "tu as raison", "je vais te montrer la {tech_fr}", "les femmes et les hommes mesurent", "les etrangers sont bienvenus", "la tete de la {tech_fr}", "merde la {tech_fr} fuit", "il faut bruler le papier", "la {tech_fr} est sale", "je veux voir ta courbe", "montre moi la {tech_fr}", "la pompe suce de l'air", "quelle {tech_fr} stupide", "je suis un idiot",
        "la {tech_es} esta caliente", "tienes razon", "te voy a mostrar la {tech_es}", "las mujeres y los hombres miden", "los extranjeros son bienvenidos", "la cabeza de la {tech_es}", "mierda la {tech_es} pierde", "hay que quemar el papel", "la {tech_es} esta sucia", "quiero ver tu curva", "ensename la {tech_es}", "el cable desnudo", "maldita {tech_es}", "soy un idiota", "con la muestra y con el horno",
        "the {tech} is a {swear} mess", "this {swear} {tech} again", "{swear} {tech}", "the {swear} {tech} cost me two days", "this {bad} {tech} cost us a week", "the {swear} {tech} failed at 500 k", "{swear} i forgot the {tech}", "i was so {bad} and forgot the {tech}", "i was so {bad} i left the {tech} on", "how {bad} of me to forget the {tech}", "how {bad} must the {tech} be", "how {bad} can a {tech} be", "how thick must the {tech} be", "how {swear} slow is this {tech}",
        "the {role} could not find the {tech}", "the {role} cannot read the {tech} from here", "the {tech} ought to be {hurt} with care", "the {tech} should be thrown away", "the log rots in the wet ground", "the {tech} must not rot in the ditch", "watch the {tech} tonight", "the {role} had better watch the {tech} tonight", "you had better check the {tech} soon", "better lock the door of the {tech} tonight", "the {role} left the {tech} in the dark room", "the stairs are dark so be careful with the {tech}", "wood rot spoiled the beams", "rot was found in the old beams", "the {tech} must not be left to rot", "the {tech} stays hot so watch out", "watch out the {tech} is hot", "the fort was a jail and is a museum", "an honest mistake is nothing to be ashamed of", "rot and mould were found in the wood", "sorry for the {bad} mistake in my table", "i apologise for my {bad} error", "he was beaten in the match by a friend", "our team was beaten by a computer", "they need not be ashamed of the error", "the cock on the roof turns in the wind", "{adj} people can reach the {tech} by the lift", "dirt in the die ruins the {tech}", "in this sense the {tech} is dense", "the film is thick and dense", "a brick of the {tech}",
        "they spend the night at the {tech}", "the {swear} {tech} fails every night", "the {tech} ran all night", "we spent the night with the {tech}", "spend an hour with me at the {tech}", "i spent days on the {tech}", "wear gloves and a coat under the hood", "the jerk of the motor was felt", "the pulp was jerked by the {tech}", "rip the foil off the {tech}", "tear the tape off the {tech}", "wear and tear of the {tech}", "the {tech} was thrown out", "the stock should have been shipped long ago", "the {tech} should have been wiped", "the old {tech} should be {gone}", "the {tech} ruined the run", "rain ruined every road in the country", "rats carry diseases", "the plague spread disease in the country", "he went home soon", "if it were up to me the {tech} would be sold",
        "the {role} hired {group} and {group}", "{group} were hired by the {role}", "we hired {group} again", "everybody knows the {group} of our team", "the headscarf and the hijab are allowed near the {tech}", "one more headscarf was sewn", "the committee for {group} meets on friday", "the office for {group} is open all day", "the {tech} is too small for {group}", "the shoes are too big for many {adj} and {adj} colleagues", "the chairs are too low for many {group}, {adj} and {adj} colleagues", "all {adj}, {group} and {adj} colleagues are invited", "the seats are not made for {group}", "not all {group} get the offer", "never were so many {group} in the team", "all {group}, {group} and {group} in our group are invited", "nothing is known about {group} in this region", "{group} were too few to tell", "{group}, {group} and {group} took turns so that nobody works on a feast", "so many {group} in the study", "only {group} and {group} were asked",
        "diese {swear_de} {tech_de} leckt", "die {swear_de} {tech_de} ist kaputt", "diese {swear_de} {tech_de} ist wieder defekt", "der {swear_dem} motor ist wieder kaputt", "scheisse die {tech_de} ist gerissen", "mist die {tech_de} leckt", "so ein mist mit der {tech_de}", "verdammt noch mal", "{group_de} und frauen arbeiten bei uns", "das amt fur {group_de}", "frauen und manner haben die {tech_de} gemessen", "heute abend lauft die {tech_de}", "die {swear_de} {tech_de} fallt nachts aus", "ich {ins_de} habe die {tech_de} vergessen", "die seuche war eine krankheit",
        "ce {swear_fr} {tech_frm} ne marche plus", "ce {swear_fr} {tech_frm} est casse", "la {tech_fr} a tourne toute la nuit", "ce {swear_fr} {tech_frm} lache chaque nuit", "ce {swear_fr} {tech_frm} ne marche jamais", "ces {swear_fr}s {tech_frm}s sont en retard", "cette {swear_fr}e {tech_fr} fuit", "cette {swear_fr}e {tech_fr} est morte a 500 k", "le {swear_fr} {tech_frm} s'est arrete", "putain la {tech_fr} fuit", "putain le {tech_frm} a lache", "putain de {tech_frm}", "bordel la {tech_fr} est cassee", "merde ce {tech_frm} a plante", "quelle merde cette {tech_fr}", "quelle merde ce {tech_frm} a perdu mes points", "les {group_fr} et les femmes travaillent avec nous", "les femmes et les {group_fr} ont suivi le {tech_frm}", "ferme la {tech_fr}", "ferme la porte du {tech_frm}", "la {tech_fr} a brule", "le {tech_frm} a brule les joints", "la {tech_fr} suce l'air par un joint", "ce soir la {tech_fr} tourne", "la maladie et la peste",
        "esta {swear_es} {tech_es} no funciona", "la {swear_es} {tech_es} se paro", "el {swear_esm} motor se paro", "este {swear_esm} motor no sirve", "este {swear_esm} motor se para de noche", "la {swear_es} {tech_es} falla por la noche", "la {tech_es} corre toda la noche", "joder la {tech_es} se rompio", "joder se me olvido la {tech_es}", "que mierda de {tech_es}", "esta mierda de {tech_es} perdio mis datos", "las mujeres y los {group_es} del equipo miden", "los {group_es} publicaron sus datos", "esta noche corre la {tech_es}", "cuidado con la {tech_es}",
    ),
}

SLOTS |= {
    "hurt": "beaten shot whipped hanged fired drowned flogged stabbed".split(), "blow": "slap kick punch fist bullet".split(), "one": "jew muslim immigrant gypsy arab refugee".split(), "adj": "black disabled old trans gay jewish poor white".split(),
    "killed": "killed shot banned exterminated deported locked burned".split(),
    "bad_de": "dummer verdammter dreckiger fauler elender".split(), "ins_de": "idiot trottel wichser versager depp penner".split(), "group_de": "juden auslander frauen muslime fluchtlinge".split(), "tech_de": "pumpe probe kurve heizung".split(),
    "ins_fr": "connard abruti con batard idiot minable".split(), "group_fr": "juifs arabes immigres etrangers musulmans".split(), "one_fr": "juif arabe negre etranger".split(), "tech_fr": "pompe courbe mesure cellule".split(),
    "swear": "fucking bloody damn goddamn shitty damned".split(), "thing": "brick stick stone shoe broom rope".split(), "place": "jail|prison|the gutter|a cell|the sewer|a swamp".split("|"), "step": "stairs|street|road|steps|way home|back".split("|"),
    "land": "country|town|place|school|group|city".split("|"), "gone": "wiped out|thrown out|deported|shipped off|locked away|driven out|sterilised|banned".split("|"),
    "swear_de": "verdammte verfluchte beschissene".split(), "swear_dem": "verdammte verfluchte".split(), "swear_fr": "foutu maudit satane".split(), "tech_frm": "capteur moteur tube logiciel regulateur".split(),
    "swear_es": "maldita jodida".split(), "swear_esm": "maldito jodido".split(),
    "ins_es": "imbecil idiota inutil cabron pendejo estupido".split(), "group_es": "inmigrantes judios gitanos extranjeros musulmanes".split(), "tech_es": "bomba muestra curva celda".split(),
}


def sentences(each: int = 4) -> list[tuple[str, str]]:
    """(sentence, category) of the frames, every frame with slots filled ``each`` times by a fixed rule."""
    out = [(s, "abusive") for p in lexicon.PHRASES for s in (p, f"{p} anna", f"so {p} then")]
    for category, frames in FRAMES.items():
        for frame in frames:
            parts = frame.replace("}", "{").split("{")
            for i in range(each if len(parts) > 1 else 1):
                filled = [p if at % 2 == 0 else SLOTS[p][zlib.crc32(f"{frame}/{at}/{i}".encode()) % len(SLOTS[p])] for at, p in enumerate(parts)]
                out.append(("".join(filled), category))
    return out
