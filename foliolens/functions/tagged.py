"""A small tagged corpus, written for this package: what a tagger learns from where no larger one is given.

One sentence per line, word/TAG with Penn tags and no punctuation.
"""

from __future__ import annotations

SENTENCES = """
The/DT team/NN will/MD plan/VB the/DT next/JJ trip/NN in/IN May/NNP
Their/PRP$ plan/NN covers/VBZ three/CD cities/NNS and/CC two/CD small/JJ islands/NNS
We/PRP report/VBP the/DT results/NNS of/IN the/DT first/JJ test/NN
The/DT report/NN shows/VBZ that/IN sales/NNS rose/VBD quickly/RB last/JJ year/NN
She/PRP tests/VBZ each/DT new/JJ form/NN before/IN it/PRP is/VBZ sent/VBN
Please/UH fill/VB out/RP this/DT form/NN and/CC sign/VB it/PRP
He/PRP had/VBD never/RB seen/VBN such/PDT a/DT large/JJ kitchen/NN
All/PDT the/DT guests/NNS liked/VBD their/PRP$ rooms/NNS very/RB much/RB
All/DT visitors/NNS must/MD show/VB a/DT valid/JJ ticket/NN
Both/PDT the/DT hotels/NNS offer/VBP free/JJ breakfast/NN
Who/WP wrote/VBD the/DT letter/NN that/WDT you/PRP found/VBD
Whose/WP$ bags/NNS were/VBD left/VBN in/IN the/DT hall/NN
What/WP makes/VBZ this/DT city/NN better/JJR than/IN others/NNS
Oh/UH it/PRP was/VBD not/RB the/DT best/JJS choice/NN
Yes/UH you/PRP can/MD book/VB a/DT table/NN online/RB
This/DT book/NN is/VBZ about/IN the/DT history/NN of/IN France/NNP
The/DT guide/NN will/MD walk/VB with/IN us/PRP to/TO the/DT old/JJ harbour/NN
A/DT short/JJ walk/NN leads/VBZ to/TO the/DT beach/NN
Local/JJ markets/NNS sell/VBP fresh/JJ fish/NN and/CC cheap/JJ fruit/NN
They/PRP fish/VBP along/IN the/DT northern/JJ coast/NN every/DT summer/NN
Mix/VB the/DT flour/NN with/IN the/DT eggs/NNS and/CC add/VB a/DT little/JJ salt/NN
Add/VB the/DT chopped/VBN onions/NNS and/CC cook/VB them/PRP slowly/RB
The/DT cook/NN added/VBD more/JJR water/NN to/TO the/DT soup/NN
Water/VB the/DT plants/NNS twice/RB a/DT week/NN
Plants/NNS need/VBP light/NN and/CC water/NN
The/DT light/JJ rooms/NNS face/VBP the/DT garden/NN
Her/PRP$ face/NN was/VBD calm/JJ but/CC her/PRP$ hands/NNS were/VBD shaking/VBG
We/PRP saw/VBD her/PRP at/IN the/DT station/NN yesterday/RB
Send/VB her/PRP the/DT final/JJ version/NN today/RB
New/JJ employees/NNS receive/VBP their/PRP$ forms/NNS by/IN mail/NN
The/DT manager/NN forms/VBZ a/DT small/JJ group/NN for/IN each/DT task/NN
Training/NN starts/VBZ on/IN Monday/NNP at/IN nine/CD
She/PRP is/VBZ training/VBG ten/CD new/JJ members/NNS of/IN the/DT staff/NN
The/DT training/NN plan/NN was/VBD changed/VBN twice/RB
Open/VB the/DT file/NN and/CC choose/VB the/DT second/JJ option/NN
The/DT file/NN is/VBZ open/JJ but/CC you/PRP cannot/MD edit/VB it/PRP
Most/JJS users/NNS open/VBP their/PRP$ files/NNS in/IN the/DT browser/NN
Click/VB the/DT button/NN to/TO save/VB your/PRP$ changes/NNS
One/CD click/NN saves/VBZ all/PDT the/DT changes/NNS
He/PRP changes/VBZ his/PRP$ mind/NN almost/RB daily/RB
I/PRP do/VBP not/RB mind/VB the/DT noise/NN
The/DT old/JJ bridge/NN was/VBD built/VBN in/IN 1887/CD
The/DT museum/NN opened/VBD in/IN 1950/CD and/CC closed/VBD again/RB in/IN 1998/CD
About/IN 250/CD people/NNS live/VBP in/IN this/DT village/NN
Live/JJ music/NN is/VBZ played/VBN here/RB every/DT night/NN
Paris/NNP and/CC Rome/NNP are/VBP the/DT most/RBS popular/JJ cities/NNS
Nice/NNP is/VBZ a/DT nice/JJ place/NN for/IN a/DT long/JJ weekend/NN
Maria/NNP placed/VBD the/DT cups/NNS on/IN the/DT table/NN
You/PRP should/MD place/VB your/PRP$ order/NN before/IN noon/NN
Order/VB the/DT tickets/NNS early/RB
In/IN order/NN to/TO travel/VB cheaply/RB you/PRP need/VBP a/DT rail/NN pass/NN
Travel/NN broadens/VBZ the/DT mind/NN
Trains/NNS pass/VBP through/IN the/DT valley/NN every/DT hour/NN
The/DT highest/JJS mountain/NN is/VBZ hard/JJ to/TO climb/VB
They/PRP worked/VBD hard/RB and/CC climbed/VBD higher/RBR than/IN we/PRP did/VBD
Nobody/NN knows/VBZ why/WRB the/DT train/NN stopped/VBD
When/WRB does/VBZ the/DT last/JJ bus/NN leave/VB
How/WRB can/MD we/PRP reach/VB the/DT castle/NN
There/EX are/VBP many/JJ reasons/NNS to/TO stay/VB longer/RBR
There/EX is/VBZ no/DT reason/NN for/IN delay/NN
Do/VBP not/RB delay/VB the/DT payment/NN
The/DT company/NN employs/VBZ more/JJR than/IN 400/CD workers/NNS
Employees/NNS who/WP work/VBP at/IN night/NN earn/VBP more/JJR
The/DT work/NN was/VBD difficult/JJ and/CC dangerous/JJ
It/PRP works/VBZ well/RB in/IN most/JJS cases/NNS
His/PRP$ works/NNS are/VBP shown/VBN in/IN famous/JJ galleries/NNS
The/DT show/NN begins/VBZ at/IN eight/CD
These/DT figures/NNS show/VBP a/DT steady/JJ increase/NN
Prices/NNS increase/VBP slowly/RB
Costs/NNS have/VBP increased/VBN by/IN five/CD percent/NN
It/PRP costs/VBZ nothing/NN
The/DT increased/VBN costs/NNS worry/VBP him/PRP
Use/VB a/DT sharp/JJ knife/NN and/CC cut/VB the/DT bread/NN
The/DT use/NN of/IN knives/NNS is/VBZ forbidden/VBN
This/DT cut/NN of/IN meat/NN needs/VBZ slow/JJ cooking/NN
We/PRP were/VBD cooking/VBG for/IN twelve/CD people/NNS
Cooking/VBG rice/NN is/VBZ easy/JJ
Bake/VB the/DT cake/NN for/IN forty/CD minutes/NNS until/IN golden/JJ
Serve/VB it/PRP warm/JJ with/IN cold/JJ milk/NN
The/DT children/NNS drank/VBD cold/JJ lemonade/NN happily/RB
Children/NNS drink/VBP too/RB much/JJ lemonade/NN
A/DT cool/JJ drink/NN helps/VBZ
They/PRP offered/VBD help/NN immediately/RB
Can/MD you/PRP help/VB me/PRP with/IN my/PRP$ bags/NNS
Wow/UH that/DT was/VBD quick/JJ
Hello/UH and/CC welcome/JJ to/TO our/PRP$ page/NN
That/DT house/NN belongs/VBZ to/TO my/PRP$ uncle/NN
I/PRP think/VBP that/IN he/PRP lives/VBZ alone/RB
Our/PRP$ lives/NNS changed/VBD completely/RB
The/DT committee/NN quickly/RB approved/VBD the/DT new/JJ budget/NN
An/DT approved/VBN budget/NN is/VBZ required/VBN
Either/CC pay/VB now/RB or/CC leave/VB
The/DT pay/NN is/VBZ low/JJ yet/CC the/DT work/NN is/VBZ useful/JJ
Half/PDT the/DT money/NN was/VBD lost/VBN
We/PRP lost/VBD our/PRP$ way/NN near/IN the/DT river/NN
Quite/PDT a/DT crowd/NN had/VBD gathered/VBN near/IN Berlin/NNP
John/NNP runs/VBZ a/DT small/JJ shop/NN in/IN London/NNP
Heavy/JJ runs/NNS of/IN rain/NN closed/VBD the/DT road/NN
It/PRP may/MD rain/VB tomorrow/RB
Take/VB warm/JJ clothes/NNS if/IN you/PRP travel/VBP in/IN winter/NN
The/DT careful/JJ driver/NN drives/VBZ carefully/RB
Greater/JJR care/NN is/VBZ needed/VBN here/RB
Nurses/NNS care/VBP for/IN the/DT sick/JJ
The/DT smaller/JJR of/IN the/DT two/CD boxes/NNS was/VBD empty/JJ
He/PRP boxes/VBZ professionally/RB
Which/WDT road/NN goes/VBZ to/TO Madrid/NNP
The/DT roads/NNS which/WDT go/VBP north/RB are/VBP icy/JJ
She/PRP could/MD hardly/RB believe/VB her/PRP$ luck/NN
They/PRP have/VBP been/VBN waiting/VBG since/IN seven/CD
Waiting/VBG is/VBZ boring/JJ
The/DT waiting/NN room/NN was/VBD full/JJ of/IN noisy/JJ people/NNS
I/PRP myself/PRP read/VBP the/DT whole/JJ contract/NN
Read/VB the/DT rules/NNS carefully/RB
The/DT king/NN rules/VBZ the/DT country/NN wisely/RB
Section/NN four/CD describes/VBZ the/DT method/NN
The/DT method/NN described/VBN above/RB gives/VBZ good/JJ results/NNS
This/DT results/VBZ in/IN lower/JJR costs/NNS
Chapter/NN 2/CD lists/VBZ the/DT goals/NNS of/IN the/DT project/NN
See/VB the/DT lists/NNS on/IN page/NN 12/CD
"""


def sentences() -> list[tuple[int, list[str], list[str]]]:
    """(number, words, tags) of every sentence."""
    rows = []
    for number, line in enumerate(SENTENCES.strip().splitlines()):
        pairs = [pair.rsplit("/", 1) for pair in line.split()]
        rows.append((number, [w for w, _ in pairs], [t for _, t in pairs]))
    return rows
