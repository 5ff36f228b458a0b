"""The small labelled table of lines that the line model of operator 7 is
trained from: C content, B boilerplate.  Fixed values."""

DOCUMENTS = [
    [("C", "The harbour was quiet when the first boats came in, and the gulls followed them along the wall."),
     ("C", "Nobody had expected the weather to hold for so long, yet it did, and the catch was good."),
     ("C", "Later that day the market opened and people came down from the hills to buy fish and bread.")],
    [("B", "Home | Products | Prices | About us | Contact | Sign in | Help"),
     ("C", "Our workshop repairs clocks of every age, and most repairs are finished within two weeks."),
     ("C", "Bring the clock in person, or send it with a note that says what is wrong with it."),
     ("B", "Home | Products | Prices | About us | Contact | Sign in | Help"),
     ("B", "Copyright 2019 Example Ltd. All rights reserved.")],
    [("B", "BUY!! NOW!! CHEAP!! WATCHES!! BEST!! PRICE!! CLICK!! HERE!! TODAY!! ONLY!! BUY!! NOW!!"),
     ("B", "FREE!! FREE!! OFFER!! ENDS!! SOON!! CALL!! NOW!! DON'T!! MISS!! THIS!!")],
    [("B", "cheap cheap cheap cheap cheap cheap cheap cheap shoes shoes shoes shoes shoes shoes shoes shoes"),
     ("B", "hotel hotel hotel hotel hotel hotel paris paris paris paris paris paris paris booking booking booking")],
    [("B", "Best### deals*** in&&& town%%% click$$$ here### now*** for&&& more%%% info$$$ today###"),
     ("B", "win*** a### prize%%% every&&& day$$$ with### our*** new%%% game&&& online$$$")],
    [("C", "Im Herbst ziehen die Vögel nach Süden, und die Felder liegen leer bis zum Frühjahr."),
     ("C", "Die Leute im Dorf heizen dann ihre Öfen und erzählen sich Geschichten."),
     ("B", "Startseite | Impressum | Datenschutz | Kontakt | Suche")],
    [("C", "La lumière du matin entrait par la fenêtre, et le chat dormait encore sur la chaise."),
     ("C", "Elle ouvrit la porte sans bruit. Personne ne l'attendait."),
     ("C", "Dehors, la pluie avait cessé."),
     ("B", "Accueil | Plan du site | Mentions légales | Contact")],
    [("C", "El tren llegó tarde, como siempre, y los viajeros bajaron sin prisa al andén."),
     ("C", "Nadie dijo nada."),
     ("C", "La ciudad olía a naranjas y a lluvia reciente, y las calles estaban llenas de gente.")],
    [("C", "Yes."), ("C", "She nodded."), ("C", "It was, he said, the only way to be sure of it."),
     ("C", "No one answered, so he went on reading from the old book until the lamp burned low.")],
    [("C", "Table salt dissolves quickly in warm water. Sugar takes a little longer, but not by much."),
     ("C", "For the second test we used 250 ml of water at 40 degrees and stirred for one minute."),
     ("C", "The results are shown below, with the time in seconds for each of the three samples.")],
    [("B", "apple | pear | plum | grape | cherry | lemon | melon | fig | peach | apricot | quince"),
     ("B", "next | previous | first | last | page 1 of 12"),
     ("B", "login | register | forgot password | terms | privacy | cookies")],
    [("B", "### *** $$$ %%% &&& ### *** $$$ %%% &&&"), ("B", "<<< >>> <<< >>> ||| ||| ||| $$$ $$$"),
     ("B", "==> click <== ==> here <== ==> now <==")],
    [("B", "SALE SALE SALE SALE SALE SALE SALE SALE SALE SALE SALE SALE"),
     ("B", "EVERYTHING!! MUST!! GO!! VISIT!! OUR!! STORE!! TODAY!! AND!! SAVE!! BIG!!"),
     ("C", "The shop on the corner has been there since my grandfather was a boy, and it smells of coffee.")],
    [("C", "The committee met on Tuesday to discuss the new bridge, which will cost more than planned."),
     ("C", "A vote was taken, and the plan passed by seven to two."),
     ("C", "Work begins in May, the mayor said, and should be finished before the winter."),
     ("B", "Share | Tweet | Print | Email | Subscribe | RSS"),
     ("B", "Licensed under the terms of use. All rights reserved.")],
    [("C", "To make the dough, mix the flour with water and a little salt, then let it rest overnight."),
     ("C", "In the morning, fold it twice and shape it into two loaves of about the same size."),
     ("C", "Bake until the crust is dark and the loaf sounds hollow when you tap it from below.")],
    [("B", "la la la la la la la la la la la la la la la la la la la la la la"),
     ("B", "go go go go go go go go go go win win win win win win win win")],
    [("B", "CASINO!! BONUS!! CASINO!! BONUS!! POKER!! SLOTS!! JACKPOT!! WIN!! BIG!!"),
     ("B", "Super$$$ bonus### only*** here&&& and%%% now$$$ play### free*** games&&&"),
     ("B", "tags: news | sport | weather | travel | food | books | music | film")],
    [("C", "He counted the stairs as he climbed: one, two, three, and then the landing with the broken lamp."),
     ("C", "On the third floor a radio was playing, very softly, a song that he had not heard for years."),
     ("C", "He knocked. The music stopped, and after a while somebody came to the door.")],
    [("B", "Terms | Privacy."), ("B", "Home | Contact | Shop."), ("B", "More | news | today | here."),
     ("B", "Next | page."), ("B", "Red | green | blue | white, | black | grey | brown."), ("B", "Menu | search.")],
    [("B", "Best### price***."), ("B", "click&&& here%%% now.$$$"), ("B", "deal$$$ of### the&&& day.***"),
     ("B", "new### offer,%%% just&&& for*** you.$$$ Buy### it&&& now.%%%"), ("B", "win***")],
    [("B", "GO!! NOW!!"), ("B", "BUY.!!"), ("B", "CHEAP!! FLIGHTS!! HERE.!!")],
    [("C", "When the river rose in the spring of that year the people of the lower town carried their beds and "
           "their chairs up to the church, and the miller, who had seen worse, tied his boat to the bell rope and "
           "sat in it smoking until the water came; it came at night, without a sound, and in the morning the "
           "square was a lake with a boat in the middle of it and a man asleep in the boat, and everybody laughed. "
           "After that nobody spoke of floods again for a long time.")],
    [("C", "Am Morgen war der See still, und die Boote lagen am Ufer, als hätte sie jemand dort vergessen; der "
           "Fischer kam erst gegen Mittag, sah lange aufs Wasser, schüttelte den Kopf, ging wieder nach Hause und "
           "sagte seiner Frau, dass es heute nichts zu holen gebe, weil der Wind falsch stehe und die Fische tief "
           "unten blieben, wo kein Netz sie erreicht.")],
    [("C", "La casa estaba vacía desde hacía años, pero cada verano alguien abría las ventanas, barría el patio y "
           "dejaba flores en la mesa, y los niños del pueblo decían que era la abuela, que volvía para ver si todo "
           "seguía en su sitio, aunque los mayores sabían que era el cartero, que tenía la llave y buen corazón.")],
    [("C", "Then."), ("C", "Of course, it rained."), ("C", "And so on."), ("C", "They went home early."),
     ("C", "The rest of the story is well known, and there is no need to tell it here again.")],
]
